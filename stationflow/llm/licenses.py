"""License scan: ordered signature rules behind a keyword prefilter.

A text is taken as UTF-8 bytes with A-Z in lower case and reduced to its words,
runs of a-z, 0-9 and bytes above 127, with one blank between them. A rule's
regular expression runs only if the reduced text holds one of its keywords and,
for the fuller forms of a license's name, the name itself; it starts and ends
at word borders. Of overlapping detections, one that lies within another of at
least its priority is dropped, so that ``lesser general public license`` is not
also the general one.

Base phrases are counted apart from the rules and never suppressed.

Defined results: a null or wordless text has no words, labels or places and
score 0. Texts are scanned whole; a rule can match anywhere in them. Rows are
independent of each other; other columns are never read.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm.license_rules import Signature, families
from stationflow.llm.support import utf8

# Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
BASE_CONFIDENCE = 0.6

_WORDS = bytes(c if chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz" or c > 127 else 32 for c in range(256))
DETECTION = T.ArrayType(T.StructType([
    T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType()), T.StructField("words", T.LongType()),
    T.StructField("confidence", T.DoubleType())]))
RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("base_places", T.ArrayType(T.LongType())),
    T.StructField("base_labels", T.ArrayType(T.StringType())), T.StructField("labels", T.ArrayType(T.StringType())),
    T.StructField("score", T.DoubleType()), T.StructField("detections", DETECTION)])


def reduced(text: bytes) -> bytes:
    """The lower-case words of a text, a blank before, between and after them."""
    return b" " + b" ".join(text.lower().translate(_WORDS).split()) + b" "


def compiled(pattern: str) -> re.Pattern[bytes]:
    return re.compile(b" (?:" + pattern.encode() + b")(?= )", re.DOTALL)


@cache
def rules() -> list[tuple[tuple[bytes, ...], re.Pattern[bytes], list[tuple[Signature, bytes, re.Pattern[bytes]]]]]:
    """Keywords, name and rules of each family, compiled."""
    return [
        (tuple(b" " + k.encode() for k in f.keywords), compiled(f.name), [(r, r.also.encode(), compiled(r.pattern)) for r in f.rules])
        for f in families()]


@cache
def base_patterns() -> list[tuple[str, re.Pattern[bytes]]]:
    return [(label, compiled(phrase)) for phrase, label in BASE.items()]


def detect(line: bytes) -> list[tuple[Signature, int, int]]:
    """Detections in a reduced text that no other covers, as byte intervals."""
    found = []
    for keywords, name, family in rules():
        if any(k in line for k in keywords) and name.search(line):
            for signature, also, pattern in family:
                if also in line:
                    found += [(signature, *m.span()) for m in pattern.finditer(line)]
    return suppressed(found)


def suppressed(found: list[tuple[Signature, int, int]]) -> list[tuple[Signature, int, int]]:
    """Without those that lie within a detection of at least their priority; of equal intervals the first rule's stays.

    In order of start, long before short, an interval is covered exactly if an
    earlier one reaches its end; so per priority the furthest end is enough.
    """
    kept = []
    reach: dict[int, int] = {}
    for x in sorted(found, key=lambda x: (x[1], -x[2], -x[0].priority, x[0].order)):
        if not any(end >= x[2] for priority, end in reach.items() if priority >= x[0].priority):
            kept.append(x)
        reach[x[0].priority] = max(reach.get(x[0].priority, -1), x[2])
    return kept


def scan_text(text: bytes) -> tuple:
    line = reduced(text)
    base = [(label, m.start()) for label, pattern in base_patterns() if b" license" in line for m in pattern.finditer(line)]
    found = detect(line)
    blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32) if base or found else np.zeros(0, np.int64)
    at = lambda where: int(np.searchsorted(blanks, where))  # noqa: E731  every word has a blank before it
    places = sorted(at(p) for _, p in base)
    base_labels = sorted({label for label, _ in base})
    labels = sorted({*base_labels, *(s.label for s, _, _ in found)})
    score = max([BASE_CONFIDENCE * bool(base), *(s.confidence for s, _, _ in found)], default=0.0)
    details = [
        {"label": s.label, "first_word": at(a), "words": at(b) - at(a), "confidence": s.confidence} for s, a, b in found]
    return line.count(b" ") - 1 if len(line) > 2 else 0, places, base_labels, labels, float(score), details


@F.arrow_udf(RESULT)
def scan(texts: pa.Array) -> pa.Array:
    columns = list(zip(*map(scan_text, utf8(texts)))) or [[]] * len(RESULT.fields)
    kinds = [
        pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.float64(),
        pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("words", pa.int64()), ("confidence", pa.float64())]))]
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=RESULT.fieldNames())


def licenses(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` as struct column _doc, and _found with words, base places, labels, score and detections."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"), scan(text).alias("_found"))
