"""Operators on single texts, against plain Python."""

import hashlib
import re
import tracemalloc
import zlib

import numpy as np
import pytest

from eventlab.llm import common, language_id, licenses, pieces, suffix_dedup, token_binary

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def odd(spark, schema=SCHEMA + ", bucket int, ids int, score int, class string"):
    """Nulls, empty, long, repeated and strange texts, with further columns whose names clash."""
    long = "The quick brown fox jumps over it again and again. " * 4000
    texts = [None, "", " ", "ab", "ab", "  two  spaces \n\n here ", "▁mark ▁ in it", "日本語 テキスト\t\x00\x01", "a" * 3000, long, "x " + long, "é \U0001F600 ok", "12345 !!! ???",
             "MIT License, the mit-license; GNU GENERAL PUBLIC\nLICENSE"]
    rows = [(i, t, None if i % 3 else "en", None, None, 1, 2, 3, "c") for i, t in enumerate(texts)]
    rows += [(3, "ab", "en", "s", 2, 1, 2, 3, "c"), (None, "no id here", None, None, None, 1, 2, 3, "c")]
    return spark.createDataFrame(rows, schema)


def texts_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


# -- 2 -----------------------------------------------------------------------------------

def plain_scan(text):
    words = re.findall(common.WORD_CLASS, (text or "").translate({c: c + 32 for c in range(65, 91)}))
    at, labels = [], set()
    for phrase, label in licenses.BASE.items():
        want = phrase.split()
        for i in range(len(words) - len(want) + 1):
            if words[i:i + len(want)] == want:
                at.append(i)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


@pytest.mark.parametrize("which", [sample, odd])
def test_license_scan_against_word_lists(spark, which):
    df = which(spark)
    got = {(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan_licenses(df).collect()}
    assert got == {(i, *plain_scan(t)) for i, t in texts_of(df)}
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def test_license_expressions():
    assert licenses.to_postfix("MIT OR Apache-2.0 AND GPL-2.0 WITH X".split()) == ["MIT", "Apache-2.0", "GPL-2.0", "X", "with", "and", "or"]
    assert licenses.evaluate("(MIT OR GPL-3.0-only) AND LGPL-2.1") == ({"mit", "gpl", "lgpl"}, 0.5)
    assert licenses.evaluate("GPL-2.0-only WITH Classpath-exception-2.0") == ({"gpl"}, 0.7)
    assert licenses.evaluate("MIT AND") == ({"mit"}, 0.9)
    assert licenses.evaluate(") (") == (set(), 0.0)
    row = licenses.scan("// SPDX-License-Identifier: (MIT OR CC-BY-NC-4.0)\nAll rights reserved. Licensed under CC BY-NC 4.0")
    assert row[5] == "cc-by-nc,mit,reserved" and row[6] == 0.1 and row[7] == ["(MIT OR CC-BY-NC-4.0)"]


# -- 4 -----------------------------------------------------------------------------------

def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 11, 16, 17, 20, 31, 32])
def test_packing_round_trip_and_random_access(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001)
    packed = token_binary.pack(ids, bits)
    assert len(packed) == -(-len(ids) // 8) * bits
    assert (token_binary.unpack(packed, bits, 0, len(ids)) == ids).all()
    for a, b in ((0, 0), (5, 6), (7, 900), (993, 1001)):
        assert (token_binary.unpack(packed, bits, a, b) == ids[a:b]).all()


@pytest.mark.parametrize("which", [sample, odd])
def test_token_files(spark, which):
    from tokenizers import Tokenizer

    df = which(spark).where("doc_id IS NOT NULL")
    folder = common.shared_path(spark, "tokens")
    token_binary.write_tokens(df, folder, tokenizer_path(), block=500)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_binary.read_digests(spark, folder).collect())
    library = Tokenizer.from_file(tokenizer_path())
    want, start = set(), 0
    plain = {}
    for i, t in texts_of(df):
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4")
        want.add((i, len(ids), zlib.crc32(ids.tobytes())))
        plain.setdefault(i, []).append(ids)
    assert {x[1:] for x in got} == want
    for begin, doc, size, _ in got:
        assert begin == start
        start += size
    assert [x[1] for x in got] == sorted(x[1] for x in got)
    for doc in (3, 9):
        assert sorted(x.tolist() for x in token_binary.document_ids(spark, folder, doc)) == sorted(x.tolist() for x in plain[doc])


def test_token_files_with_null_ids(spark):
    """Documents without an id come first, keep their tokens, and a real id 0 stays apart."""
    from tokenizers import Tokenizer

    rows = [(None, "no id here"), (5, "five"), (None, None), (0, "zero"), (-7, "minus seven"), (None, "no id here"), (None, "another text without an id")]
    library = Tokenizer.from_file(tokenizer_path())
    plain = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in rows]
    for block in (1, 4, 500):
        folder = common.shared_path(spark, "tokens")
        token_binary.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), folder, tokenizer_path(), block=block)
        got = sorted(token_binary.read_digests(spark, folder).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in got] == [None, None, None, None, -7, 0, 5]
        assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(i), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in plain)
        for doc in (None, 0, -7, 5, 6):
            assert sorted(x.tolist() for x in token_binary.document_ids(spark, folder, doc)) == sorted(x for i, x in plain if i == doc)


@pytest.mark.parametrize("keep", [1_000_000, 3])
def test_encoder_cuts_where_no_token_reaches_over(keep):
    from tokenizers import Tokenizer

    library, mine = Tokenizer.from_file(tokenizer_path()), token_binary.Encoder(tokenizer_path(), keep)
    texts = ["", " ", "a", "Word, word. word.\nWord\r\n\tword!?  two  ", "\n\n x", "it's don't. 'tis .'s ;'ll", "end<|endoftext|>.<|endoftext|> x<|endoftext|>", "a.b.c@d.e:80/f?g;h,1.5 1,000",
             "nb\u00a0 sp\u2003 \u3000\n\u0085 x\u200b y", "été. Привет, мир. 日本。 テ ス 한국 말 e\u0301. \U0001F600 ok", "\x00 \x1c\n\x7f .x", "x" * 200 + " " + "y" * 200 + ".", "  lead", "trail \n"]
    for _ in range(2):
        got = mine.encode(texts)
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_encoder_learns_a_word_once():
    mine = token_binary.Encoder(tokenizer_path())
    mine.encode(["x word"])
    asked, ids_of = [], mine.ids_of
    mine.ids_of = lambda texts: asked.extend(texts) or ids_of(texts)
    mine.encode(["x word. word, word\n"])
    assert all("word" not in x for x in asked)


def test_token_files_of_an_empty_table(spark):
    folder = common.shared_path(spark, "tokens")
    token_binary.write_tokens(odd(spark).limit(0), folder, tokenizer_path())
    assert token_binary.read_digests(spark, folder).count() == 0


# -- 5 -----------------------------------------------------------------------------------

def plain_repeats(texts, length=suffix_dedup.LENGTH):
    seen, out = {}, []
    rows = sorted((i if i is not None else suffix_dedup.NO_ID, t.encode()) for i, t in texts)
    for i, raw in rows:
        for a in range(len(raw) - length + 1):
            seen[raw[a:a + length]] = min(seen.get(raw[a:a + length], (i, a)), (i, a))
    for i, raw in rows:
        gone = np.zeros(len(raw) + 1, int)
        for a in range(len(raw) - length + 1):
            if seen[raw[a:a + length]] < (i, a):
                gone[a] += 1
        cover = np.convolve(gone, np.ones(length, int))[:len(raw)] > 0
        spans = int((cover & ~np.concatenate([[False], cover[:-1]])).sum()) if len(raw) else 0
        kept = bytes(np.frombuffer(raw, np.uint8)[~cover])
        out.append((i if i != suffix_dedup.NO_ID else None, len(raw), int(cover.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("which", [sample, odd])
def test_repeats_against_brute_force(spark, which):
    df = which(spark)
    got = [tuple(r) for r in suffix_dedup.repeats(df.repartition(5)).collect()]
    assert sorted(got, key=str) == sorted(plain_repeats(texts_of(df)), key=str)


def test_repeats_in_crowded_grams(spark):
    """A line that stands in many surroundings, split by longer grams or not, gives the same."""
    rng = np.random.default_rng(1)
    line = "this line of sixty letters stands in many different places.."
    word = lambda n: "".join(chr(97 + x) for x in rng.integers(0, 26, n))
    rows = [(i, word(150) + line + word(30 + i % 5) + line[:i % 60] + "q" * 130 + word(5)) for i in range(60)]
    rows += [(100 + i, rows[i][1][20:300]) for i in range(0, 60, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted(plain_repeats(rows))
    assert sorted(tuple(r) for r in suffix_dedup.repeats(df).collect()) == want
    assert sorted(tuple(r) for r in suffix_dedup.repeats(df, crowded=5).collect()) == want


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_and_common_prefixes(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(1, (2, 3, 5, 20, 200, 257)[seed], 1500)
    text[700:1000] = text[100:400]
    text = np.append(text, 0).astype(np.int16)
    order = suffix_dedup.suffix_array(text, 258)
    raw = text.tolist()
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    shared = suffix_dedup.common_prefixes(text, order, np.zeros(len(text), bool), 4000)
    for a, b in zip(order[:-1], order[1:]):
        n = 0
        while raw[a + n:a + n + 1] == raw[b + n:b + n + 1] != []:
            n += 1
        assert shared[b] == n


def test_bytes_in_use_per_byte_of_text():
    make = np.random.default_rng(3)
    words = [bytes(make.integers(97, 123, n, np.uint8)) for n in make.integers(1, 12, 2000)]
    rows = [b" ".join(words[k] for k in make.integers(0, 2000, 25)) + b"x" * 100 for _ in range(1500)]
    data, borders = np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0, *map(len, rows)])
    ids = np.arange(len(rows))

    many = np.tile(data, 24)
    ends = np.concatenate([[0], np.cumsum(np.tile(np.diff(borders), 24))])

    def most(job, size):
        tracemalloc.start()
        try:
            job()
            return tracemalloc.get_traced_memory()[1] / size
        finally:
            tracemalloc.stop()

    assert most(lambda: suffix_dedup.first_places(rows, ids, ids), len(data)) < 68
    assert most(lambda: suffix_dedup.segments(many, ends, suffix_dedup.GRAM), len(many)) < 8
    marks = many == 120
    assert (suffix_dedup.counted_before(marks, ends) == np.concatenate([[0], np.cumsum(marks)])[ends]).all()


def test_without_repeats_keeps_columns(spark):
    df = odd(spark)
    out = suffix_dedup.without_repeats(df)
    assert out.columns == df.columns
    kept = {(r.doc_id, r.text) for r in out.collect()}
    assert (0, None) in kept and (1, "") in kept and (3, "ab") in kept
    assert suffix_dedup.without_repeats(df.limit(0)).count() == 0


# -- 6 -----------------------------------------------------------------------------------

def plain_viterbi(model, text):
    """The textbook rule over the whole text at once."""
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    score = {lib.id_to_piece(i): (lib.get_score(i), i) for i in range(259, lib.get_piece_size())}
    chars = (" " + text.replace("▁", pieces.LITERAL)).replace(" ", "▁") if text else ""
    best = [(0.0, None, None)]
    for j in range(1, len(chars) + 1):
        options = []
        for i in range(max(0, j - 16), j):
            found = score.get(chars[i:j]) or ((model.unknown, -1) if j - i == 1 else None)
            if found:
                options.append((best[i][0] + found[0], i, found[1]))
        best.append(max(options, key=lambda x: (x[0], x[1])))
    out, j = [], len(chars)
    while j:
        _, i, token = best[j]
        out.append([token] if token >= 0 else [3 + b for b in chars[i:j].replace(pieces.LITERAL, "▁").encode()])
        j = i
    return [x for part in out[::-1] for x in part]


def test_viterbi_against_the_plain_rule_and_round_trip():
    model = pieces.Pieces(pieces.default_model())
    texts = ["", " ", "a", "  two  spaces \n\n here ", "▁mark ▁ in it", "日本語 テキスト\t\x00", "a" * 300, "Thnterble whshe ou", "é \U0001F600 \U0010FFFE ok", "éêçà" * 30 + "z"]
    ids = [np.frombuffer(x, "<u4") for x in model.encode(texts)]
    assert [x.tolist() for x in ids] == [plain_viterbi(model, t) for t in texts]
    assert [model.decode(x) for x in ids] == texts
    small, pieces.CELLS = pieces.CELLS, 7  # words longer than one stretch
    try:
        assert pieces.Pieces(pieces.default_model()).encode(texts) == [x.tobytes() for x in ids]
    finally:
        pieces.CELLS = small


def test_merges_against_the_library(spark):
    """The ids of a file with merge ranks are the library's, in short and long words."""
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    texts = ["", " ", "a", "hello and that", "  two  spaces \n\n here ", "日本語 テキスト\t", "a" * 300, " " * 30 + "x", "Thnterble whshe ou", "é \U0001F600 \U0010FFFE ok", "éêçà" * 90 + "z", "the" * 100]
    model = pieces.pieces(pieces.default_model())
    want = [lib.encode(t) for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in model.encode(texts)] == want
    old, pieces.LONG = pieces.LONG, 0  # every word by the heap
    try:
        assert [np.frombuffer(x, "<u4").tolist() for x in pieces.Merges(pieces.default_model()).encode(texts)] == want
    finally:
        pieces.LONG = old
    rows = pieces.encode(sample(spark), pieces.default_model()).join(sample(spark).select("doc_id", "text"), "doc_id").collect()
    assert rows and all(list(r.ids) == lib.encode(r.text) for r in rows)


def test_library_decodes_the_same_text(spark):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    out = pieces.encode(sample(spark), pieces.default_model())
    rows = out.join(sample(spark).select("doc_id", "text"), "doc_id").collect()
    assert len(rows) == sample(spark).count()
    for r in rows:
        assert r.n_tokens == len(r.ids) and lib.decode(list(r.ids)) == r.text


def test_tokens_of_odd_rows(spark):
    df = odd(spark)
    out = pieces.with_tokens(df)
    assert out.columns == [c for c in df.columns if c != "ids"] + ["n_tokens", "ids"]
    assert sorted(map(str, texts_of(out))) == sorted(map(str, texts_of(df)))
    assert pieces.with_tokens(df.limit(0)).count() == 0


# -- 7 -----------------------------------------------------------------------------------

def test_language_accuracy_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language_id.op7_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out)


def test_language_of_odd_rows(spark):
    df = odd(spark)
    network = language_id.fit(sample(spark))
    got = {(r.doc_id, r.text): (r["_lang"], r["_score"]) for r in language_id.predict(df, network).collect()}
    for key in ((0, None), (1, ""), (2, " "), (12, "12345 !!! ???")):
        assert got[key] == ("und", 0.0)
    assert got[3, "ab"][0] in network.languages
    again = {(r.doc_id, r.text): (r["_lang"], r["_score"]) for r in language_id.predict(df.repartition(4), network).collect()}
    assert {k: v[0] for k, v in again.items()} == {k: v[0] for k, v in got.items()}
    kept = language_id.keep_known(sample(spark).unionByName(df.select("doc_id", "text", "lang", "source", "n_chars")))
    assert kept.columns == sample(spark).columns
    assert language_id.fit(df.where("lang = 'none'")) is None
    assert {r["_lang"] for r in language_id.predict(df, None).collect()} == {"und"}
    assert language_id.keep_known(df.limit(0)).count() == 0


def test_tables_equal_the_convolution():
    make = np.random.default_rng(0)
    network = language_id.Network(["a", "b", "c"])
    windows = make.integers(0, 256, (5, language_id.WINDOW)).astype(np.uint8)
    coded = network.code[windows]
    pooled = []
    for w, f in zip(language_id.WIDTHS, network.filters):
        pooled.append(np.stack([[(coded[k, i:i + w].reshape(-1) @ f) for i in range(language_id.WINDOW - w + 1)] for k in range(5)]).max(axis=1))
    hidden = np.maximum(np.concatenate(pooled, axis=1) + network.bias, 0)
    want = language_id.softmax(hidden @ network.out + network.shift)
    assert np.allclose(np.exp(language_id.Reader(network).log_chances(windows)), want, atol=1e-4)
