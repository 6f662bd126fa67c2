"""Cross-tokenizer alignment against a plain version over whole texts."""

from collections import Counter
from hashlib import sha256
from itertools import accumulate

import pytest
import sentencepiece
from tokenizers import Tokenizer

import public_tokenizers
from eventlab.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n_a string, chunk int"


def tokens_of(texts):
    """``(ids, bytes)`` of both sides for each text; None where the bytes are not the text's."""
    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    letters = alignment.byte_alphabet()
    for text in texts:
        if not text:
            yield None
            continue
        x = one.encode(" " + text, add_special_tokens=False)
        y = two.encode(text)
        sides = [(x.ids, [bytes(letters[c] for c in t) for t in x.tokens]),
                 (y, [bytes([int(p[1:-1], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(y, map(two.id_to_piece, y))])]
        yield sides if all(b"".join(b) == (" " + text).encode() for _, b in sides) else None


def brute(rows):
    counts, each = Counter(), []
    for sides in tokens_of([text for _, text in rows]):
        if sides is None:
            each.append(None)
            continue
        (a, bytes_a), (b, bytes_b) = sides
        ends = [list(accumulate(map(len, x))) for x in (bytes_a, bytes_b)]
        pairs = [(x, y) for x, at in zip(a, ends[0]) for y in [dict(zip(ends[1], b)).get(at)] if y is not None] if len(a) < 400 else \
            [(x, by[at]) for by in [dict(zip(ends[1], b))] for x, at in zip(a, ends[0]) if at in by]
        groups, i, j = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            p, q = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            i, j = p, q
        assert i == len(a) and j == len(b)
        counts.update(pairs)
        each.append((len(a), len(b), groups, pairs))
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for (doc, _), x in zip(rows, each):
        if x is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((doc, x[0], x[1], len(x[2]), len(x[3]), sum(counts[p] == top[p[1]] for p in x[3]), sum(counts[p] for p in x[3]), sha256(";".join(x[2]).encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **options):
    out = alignment.align(spark.createDataFrame([(k, v, "x", 1) for k, v in rows], SCHEMA), A, B, **options)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


ODD = [None, "", " ", "  two  spaces ", "\n\n a\tb", "a piece mark ▁ inside", "▁", "<|endoftext|> and </s> <s> <0x41> as text", "Straße, naïve café — 𝄞 😀😀 日本語のテキスト", "x" * 3000, "日本" * 2000,
       "a\u0000b", "﻿mark", "é combining", "1234567890 3.14159", "don't can't we'll I'D", "word", "word", " word", "word ", "\r\n", "ﬁ ligature ½", "a" * 50 + " " * 50 + "b"]


def test_odd_texts(spark):
    rows = [(i, text) for i, text in enumerate(ODD)] + [(None, "no id"), (5, "another five"), (5, "another five")]
    got = found(spark, rows)
    assert got == brute(rows)
    assert {r[0] for r in got if r[1] == 0} >= {0, 1}
    assert found(spark, []) == [] and found(spark, [(1, None)]) == [(1, 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("options", [{}, {"windows": 300, "different": 100}])
def test_documents_in_chunks(spark, options):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    rows = [(i, text) for i, text in enumerate(texts[:60] + ODD + texts[:5])]
    rows.append((1000, " ".join(x for x in texts[:40] if x)))
    assert found(spark, rows, **options) == brute(rows)


def test_portions_and_hashes_that_agree(spark, monkeypatch):
    both = alignment.both_of(A, B)
    texts = ["one two three", "", "four five one two", "six"]
    body = "".join(texts).encode()
    borders = alignment.np.cumsum([0] + [len(x) for x in texts])
    data = alignment.np.frombuffer(body, alignment.np.uint8)
    plain, clash = alignment.Chunk(both), alignment.Chunk(both)
    plain.add([1, 2, 3, 4], texts, data, borders)
    monkeypatch.setattr(alignment, "span_hash", lambda prefix, begin, end: alignment.np.zeros(len(begin), alignment.U64))
    clash.add([1, 2, 3, 4], texts, data, borders)
    assert plain.rows == clash.rows and len(clash.texts) == len(set(clash.texts)) and sorted(plain.texts) == sorted(clash.texts)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in alignment.op12_alignment(spark, folder).collect()), key=str) == brute(rows)
