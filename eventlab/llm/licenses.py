"""License scans: an Aho-Corasick automaton finds tags and notice phrases, a shunting-yard
parser evaluates licence expressions.

A text is lower-cased in A-Z and cut into words; the automaton runs over the words joined by
single spaces, so a phrase is found wherever its words stand one after another.  Behind an
identifier tag the rest of the line is parsed as an expression of licence ids with ``AND``,
``OR``, ``WITH`` and parentheses; an expression that does not parse counts as far as its ids
are known.

``score`` says how freely the text may be used by what was found: an id has its class's value,
``AND`` takes the smaller, ``OR`` the larger value, ``WITH`` moves half-way to 1, and all
findings hold together, so the smallest counts.  Without any finding it is 0.

A null or empty text has no words: counts are 0, places null, labels empty.  Repeated rows
are scanned each for itself.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlab.llm.common import LOWER_WORDS, in_small_batches, table

# Phrases as lower-case words, the label each gives, and how free the label is.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = {
    "all rights reserved": "reserved", "bsd license": "bsd", "cc by": "cc-by", "cc by nc": "cc-by-nc", "cc by sa": "cc-by-sa",
    "cc0": "public-domain", "creative commons attribution": "cc-by", "eclipse public license": "epl", "isc license": "isc",
    "lesser general public license": "lgpl", "mozilla public license": "mpl", "public domain": "public-domain",
    "permission is hereby granted free of charge": "mit", "the unlicense": "public-domain",
}
FREEDOM = {
    "public-domain": 1.0, "mit": 0.9, "bsd": 0.9, "isc": 0.9, "apache": 0.9, "cc-by": 0.8, "mpl": 0.6, "epl": 0.6, "lgpl": 0.5,
    "cc-by-sa": 0.5, "gpl": 0.4, "cc-by-nc": 0.2, "reserved": 0.1, "other": 0.3,
}
IDS = {
    "0bsd": "bsd", "agpl": "gpl", "apache": "apache", "bsd": "bsd", "cc0": "public-domain", "cc-by": "cc-by", "cc-by-nc": "cc-by-nc",
    "cc-by-sa": "cc-by-sa", "epl": "epl", "gpl": "gpl", "isc": "isc", "lgpl": "lgpl", "mit": "mit", "mpl": "mpl", "unlicense": "public-domain",
}
TAG = re.compile(r"spdx-license-identifier[ \t]*:?[ \t]*([^\r\n]*)", re.IGNORECASE)
TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+-]*")
RANK = {"or": 1, "and": 2, "with": 3}
COLUMNS = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
           "expressions array<string>")


def label_of(name: str) -> str:
    """The label of a licence id: the longest known beginning, cut at ``-``."""
    parts = name.lower().rstrip("+").split("-")
    for size in range(len(parts), 0, -1):
        if label := IDS.get("-".join(parts[:size])):
            return label
    return "other"


def to_postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard; raises ValueError where operands or parentheses don't fit."""
    out: list[str] = []
    waiting: list[str] = []
    operand = True  # what has to come next
    for token in tokens:
        word = token.lower()
        if token == "(":
            if not operand:
                raise ValueError("operator expected")
            waiting.append(token)
        elif token == ")":
            if operand or "(" not in waiting:
                raise ValueError("operand or opening parenthesis expected")
            while (top := waiting.pop()) != "(":
                out.append(top)
        elif word in RANK:
            if operand:
                raise ValueError("operand expected")
            while waiting and waiting[-1] != "(" and RANK[waiting[-1]] >= RANK[word]:
                out.append(waiting.pop())
            waiting.append(word)
            operand = True
        else:
            if not operand:
                raise ValueError("operator expected")
            out.append(token)
            operand = False
    if operand or "(" in waiting:
        raise ValueError("unfinished")
    return out + waiting[::-1]


def evaluate(text: str) -> tuple[set[str], float]:
    """Labels and freedom of an expression; trailing words that don't belong to it are cut."""
    tokens = TOKEN.findall(text)
    for size in range(len(tokens), 0, -1):
        try:
            postfix = to_postfix(tokens[:size])
        except ValueError:
            continue
        break
    else:
        return set(), 0.0
    labels: set[str] = set()
    stack: list[tuple[str, float]] = []
    for at, token in enumerate(postfix):
        if token not in RANK:
            stack.append((token, FREEDOM[label_of(token)]))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            labels.add(label_of(left[0]))
            stack.append((left[0], (1 + left[1]) / 2))
        else:
            labels.update(label_of(x) for x, _ in (left, right) if x)
            stack.append(("", (min if token == "and" else max)(left[1], right[1])))
    if stack[0][0]:
        labels.add(label_of(stack[0][0]))
    return labels, stack[0][1]


_AUTOMATON = []


def automaton():
    """Built once in each worker process; phrases stand between spaces."""
    if not _AUTOMATON:
        import ahocorasick

        made = ahocorasick.Automaton()
        for phrase, label in {**NOTICES, **BASE}.items():
            made.add_word(f" {phrase} ", (phrase, label))
        made.add_word("spdx license identifier ", ("", ""))
        made.make_automaton()
        _AUTOMATON.append(made)
    return _AUTOMATON[0]


def scan(text: str | None) -> tuple:
    """Word count, places of base phrases, labels, score and expressions of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_WORDS).split(b" ")
    words = [x for x in words if x]
    line = f" {b' '.join(words).decode('latin-1')} "
    places, base, tags = [], set(), False
    notices: list[tuple[int, int, str]] = []
    for end, (phrase, label) in automaton().iter(line):
        if not phrase:
            tags = True
            continue
        begin = end - len(phrase) - 1
        if phrase in BASE:
            base.add(label)
            places.append(line.count(" ", 0, begin))
        while notices and notices[-1][0] >= begin:  # a phrase inside a longer one says nothing of its own
            notices.pop()
        if not notices or notices[-1][1] < end:
            notices.append((begin, end, label))
    labels = base | {x[2] for x in notices}
    values = [FREEDOM[x] for x in labels]
    expressions = []
    if tags:
        for found in TAG.finditer(text):
            named, value = evaluate(found[1])
            if named:
                expressions.append(found[1].strip())
                labels |= named
                values.append(value)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)),
            min(values, default=0.0), expressions)


def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = list(zip(*map(scan, batch["text"].to_pylist()))) or [()] * 8
        kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(list(x), k) for x, k in zip(found, kinds))],
                                         names=[x.split()[0] for x in COLUMNS.split(", ")])


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document; see the module."""
    return in_small_batches(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))).mapInArrow(scanned, COLUMNS)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and tags of every document."""
    return scan_licenses(table(spark, sf_dir, "documents"))
