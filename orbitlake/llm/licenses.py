"""Short licence notices, found through exact seeds and verified with a bounded number of edits."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitlake.llm.text import LOWER, WORD_BYTES

# Phrases, their labels, and the edits that a match may hold.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
NOTICES = (
    ("cc by", "cc-by", 0),
    ("cc by nc", "cc-by-nc", 0),
    ("cc by nd", "cc-by-nd", 0),
    ("cc by sa", "cc-by-sa", 0),
    ("all rights reserved", "reserved", 2),
    ("apache license", "apache", 1),
    ("apache software license", "apache", 2),
    ("boost software license", "boost", 2),
    ("bsd license", "bsd", 1),
    ("creative commons", "creative-commons", 1),
    ("eclipse public license", "epl", 2),
    ("general public license", "gpl", 2),
    ("lesser general public license", "lgpl", 2),
    ("licensed under the mit", "mit", 2),
    ("mit license", "mit", 1),
    ("mozilla public license", "mpl", 2),
    ("released into the public domain", "public-domain", 3),
    ("redistribution and use in source and binary forms", "bsd", 4),
    ("permission is hereby granted free of charge", "mit", 4),
)

_TO_WORDS = bytes(LOWER[i] if WORD_BYTES[LOWER[i]] else 0x20 for i in range(256))


def word_text(text: bytes) -> str:
    """The words of a text, lower-cased and joined by single spaces."""
    return b" ".join(text.translate(_TO_WORDS).split()).decode()


class Finder:
    """All notices behind one automaton of seeds; built once in each task."""

    def __init__(self) -> None:
        self.automaton = ahocorasick.Automaton()
        self.patterns = []
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, (phrase, _, edits) in enumerate(NOTICES):
            self.patterns.append(regex.compile(f"(?b)(?:{phrase}){{e<={edits}}}"))
            # Edits touch at most as many pieces as there are edits: one piece more is left whole.
            cuts = [round(i * len(phrase) / (edits + 1)) for i in range(edits + 2)]
            for a, b in zip(cuts, cuts[1:]):
                seeds.setdefault(phrase[a:b], []).append((number, a))
        for seed, users in seeds.items():
            self.automaton.add_word(seed, (len(seed), users))
        self.automaton.make_automaton()

    def spans(self, words: str) -> list[tuple[str, int, int, int, int]]:
        """(phrase, first word, words, edits, letters) of all matches, whole words each."""
        tried, found = set(), set()
        for end, (size, users) in self.automaton.iter(words):
            for number, ahead in users:
                phrase, _, edits = NOTICES[number]
                begin = end + 1 - size - ahead
                if (number, begin) in tried or begin + edits < 0:
                    continue
                tried.add((number, begin))
                found |= self._verified(words, number, begin)
        listed, at, number = [], 0, 0
        for begin, end, phrase, edits in sorted(found):
            number += words.count(" ", at, begin)
            at = begin
            listed.append((phrase, number, words.count(" ", begin, end) + 1, edits, len(phrase)))
        return listed

    def _verified(self, words: str, number: int, begin: int) -> set[tuple[int, int, str, int]]:
        """Matches that start within the allowed edits of ``begin``, from word to word."""
        phrase, _, edits = NOTICES[number]
        size, last = len(phrase), len(words)
        if begin >= 0 and (not begin or words[begin - 1] == " ") and words.startswith(phrase, begin):
            if begin + size == last or words[begin + size] == " ":
                return {(begin, begin + size, phrase, 0)}
        found = set()
        for start in range(max(begin - edits, 0), min(begin + edits + 1, last) if edits else 0):
            if start and words[start - 1] != " ":
                continue
            for stop in range(max(start + size - edits, start + 1), min(start + size + edits, last) + 1):
                if stop < last and words[stop] != " ":
                    continue
                match = self.patterns[number].fullmatch(words, start, stop)
                if match:
                    found.add((start, stop, phrase, sum(match.fuzzy_counts)))
        return found


_SPANS = "array<struct<phrase: string, label: string, first: long, words: long, edits: int>>"


def license_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, score, spans) of every document: all matches, in order of their start.

    ``score`` is the share of letters that are right in the best match, 0 without any. Null and
    empty texts have no words and no spans; repeated rows are searched each on their own.
    """
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            *T.StructType.fromDDL(f"n_words long, score double, spans {_SPANS}"),
        ]
    )
    labels = {phrase: label for phrase, label, _ in NOTICES}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for batch in batches:
            sizes, scores, spans = [], [], []
            for text in batch.column("text").cast(pa.large_binary()):
                words = word_text(text.as_py() or b"")
                sizes.append(words.count(" ") + 1 if words else 0)
                listed = finder.spans(words)
                scores.append(max([0.0, *(1 - s[3] / s[4] for s in listed)]))
                spans.append(
                    [
                        {"phrase": s[0], "label": labels[s[0]], "first": s[1], "words": s[2], "edits": s[3]}
                        for s in listed
                    ]
                )
            span_type = pa.list_(
                pa.struct(
                    [
                        ("phrase", pa.string()),
                        ("label", pa.string()),
                        ("first", pa.int64()),
                        ("words", pa.int64()),
                        ("edits", pa.int32()),
                    ]
                )
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.array(sizes, np.int64)),
                    pa.array(np.array(scores, np.float64)),
                    pa.array(spans, span_type),
                ],
                names=schema.fieldNames(),
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def license_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)."""
    found = license_spans(docs)
    phrases = F.array(*[F.lit(p) for p in BASE])
    base = F.filter("spans", lambda s: (s["edits"] == 0) & F.array_contains(phrases, s["phrase"]))
    found = found.withColumn("base", base)

    def joined(spans: str):
        return F.array_join(F.array_sort(F.array_distinct(F.col(f"{spans}.label"))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.col("base.first")).alias("first_word"),
        F.array_max(F.col("base.first")).alias("last_word"),
        joined("base").alias("base_labels"),
        joined("spans").alias("labels"),
        "score",
    )
