"""Alignment of two tokenizers' tokens by their bytes, and how often token pairs end together.

Both tokenizers run over the whole text.  A text whose tokens do not spell a space and the
text, in either, has none.  Byte offsets where both have a token end are shared ends; they cut
the tokens into groups, and the two tokens that end there are linked; as every token has bytes,
there is one of either side.

Shared ends before a token that begins with a space, in both, are anchors.  They cut a text
into windows, about a word each, of which few are different.  A window is known by its token
ids in both; its groups and its linked pairs are worked out once and remembered, and a
document is put together from its windows.

Counts over the corpus go by chunk: a chunk of documents holds its different windows, their
linked pairs, and the windows of each document as numbers.  Pairs are counted over all chunks
and the counts go back to each chunk's pairs, so that what moves are the different pairs of a
chunk, not the tokens.  Chunks are bounded in windows, and a batch of texts in bytes.

Null and empty texts, and those that are not spelled, have zeros and an empty digest.  Texts of
any length are read whole; one without spaces is one window.  Repeated rows, also of one id,
stand on their own, and their links count as often.  An empty table gives no rows.  Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlab.llm.common import U64, batches_of, mix, portions, powers, span_hash, table, utf8, written
from eventlab.llm.common import _BASE as BASE

#: Bytes of text encoded at a time; windows of a chunk, and different ones of them.
PORTION, WINDOWS, DIFFERENT = 1 << 20, 1 << 22, 400_000
CHUNKS = ("chunk long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, groups_sha256 array<string>, per_doc array<long>, "
          "windows binary, sizes binary, pairs binary, a array<int>, b array<int>, n array<long>")
DOCUMENTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_alphabet() -> dict[str, int]:
    """The bytes behind the characters of a byte-level vocabulary: printable ones stand for themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in plain]
    return {**{chr(x): x for x in plain}, **{chr(256 + i): x for i, x in enumerate(rest)}}


class Spelled:
    """Bytes of all tokens of a vocabulary, end to end."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(x) for x in tokens], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)])
        self.body = np.frombuffer(b"".join(tokens) + b"\0", np.uint8)
        self.spaced = self.body[self.begins[:-1]] == 32
        self.spaced &= self.lengths > 0

    def spell(self, ids: np.ndarray) -> np.ndarray:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begins[:-1][ids] - ends + lengths, lengths)
        return self.body[at]


class ByteLevel:
    """Ids of a byte-level vocabulary file.

    Where the file's merges are in the order of their ids, texts of plain letters and marks go
    through the same merges in a faster library; all others, and words of unusual length, through
    the file's own.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True  # their strings in a text are ordinary text
        letters = byte_alphabet()
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        known = said["model"]["vocab"]
        special = {x["id"]: x["content"].encode() for x in said["added_tokens"]}
        merged = ["".join(x.split(" ") if isinstance(x, str) else x) for x in said["model"]["merges"]]
        places = [known[x] for x in merged]
        tokens = {i: special.get(i) or bytes(letters[c] for c in x) for x, i in {**known, **{x["content"]: x["id"] for x in said["added_tokens"]}}.items()}
        self.bytes = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.fast = None
        if places == sorted(places) and said["pre_tokenizer"] == PLAIN_SPLIT and not said.get("normalizer"):
            ranks = {x: i for i, x in tokens.items() if i not in special}
            self.fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        plain = [self.fast is not None and PLAIN.fullmatch(x) is not None and LONG_WORD.search(x) is None for x in texts]
        others = iter(self.own.encode_batch([x for x, easy in zip(texts, plain) if not easy], add_special_tokens=False))
        return [self.fast.encode_ordinary(x) if easy else next(others).ids for x, easy in zip(texts, plain)]


#: Characters whose class no version of Unicode has changed: ASCII, Latin letters and marks, common punctuation.
PLAIN = re.compile("[\\t\\n\\r -~\u00a1-\u024f\u2013\u2014\u2018\u2019\u201c\u201d\u2026]*")
LONG_WORD = re.compile(r"\S{400}|\s{400}")
#: Fixed value: how a byte-level file says that it splits texts by the usual pattern.
PLAIN_SPLIT = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}


class Both:
    """The two tokenizers, and the decimal numbers of their ids."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.one = ByteLevel(path_a)
        self.a = Spelled(self.one.bytes)
        self.two = two = sentencepiece.SentencePieceProcessor(model_file=path_b)
        piece = lambda i: bytes([int(two.id_to_piece(i)[1:-1], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode()
        self.b = Spelled([b"" if two.is_control(i) or two.is_unknown(i) else piece(i) for i in range(two.get_piece_size())])
        self.decimal = Spelled([b"%d," % i for i in range(max(len(self.a.lengths), len(self.b.lengths)))])

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        return self.one.encode([" " + x for x in texts]), self.two.encode(texts, num_threads=1)


_BOTH: dict[tuple[str, str], Both] = {}


def both_of(path_a: str, path_b: str) -> Both:
    """One pair of tokenizers per worker process."""
    if (path_a, path_b) not in _BOTH:
        _BOTH[path_a, path_b] = Both(path_a, path_b)
    return _BOTH[path_a, path_b]


def prefixes(ids: np.ndarray) -> np.ndarray:
    """Sums from which :func:`span_hash` hashes any run of ids."""
    out = np.zeros(len(ids) + 1, U64)
    np.cumsum(mix(ids.astype(U64) + U64(1)) * powers(BASE, len(ids)), out=out[1:])
    return out


def gathered(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All positions of the runs, one run after another."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + count, count)


def planes(numbers: np.ndarray) -> bytes:
    """Small numbers, compressed: their lowest bytes, then their second, and so on."""
    return zlib.compress(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def from_planes(body: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(body), np.uint8).reshape(4, -1).T).reshape(-1).view("<u4").astype(np.int64)


def two_sides(first: np.ndarray, begin: np.ndarray, count: np.ndarray, second: np.ndarray, start: np.ndarray, number: np.ndarray, gap: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Runs of both sides in turn, with ``gap`` free places between two; and where each turn begins."""
    whole = count + number + gap
    at = np.concatenate([[0], np.cumsum(whole)])
    out = np.full(at[-1], -1, np.int64)
    out[gathered(at[:-1], count)] = first[gathered(begin, count)]
    out[gathered(at[:-1] + count + gap, number)] = second[gathered(start, number)]
    return out, at


class Chunk:
    """Documents put together from windows, each of which is aligned once and known by its ids."""

    def __init__(self, both: Both):
        self.both = both
        self.known: dict[bytes, int] = {}
        self.texts: list[bytes] = []
        self.groups: list[int] = []
        self.pair_no: dict[int, int] = {}
        self.pairs: list[np.ndarray] = []
        self.rows: list[tuple] = []
        self.windows: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: list, texts: list[str | None], body: np.ndarray, borders: np.ndarray) -> None:
        lists = self.both.encode([x or "" for x in texts])
        ok = np.array([bool(x) for x in texts], bool)
        sides = [np.fromiter(chain.from_iterable(x), np.int64, sum(map(len, x))) for x in lists]
        count = [np.array([len(x) for x in s], np.int64) for s in lists]
        for spelled, tokens, n in zip((self.both.a, self.both.b), sides, count):
            said, at = spelled.spell(tokens), np.concatenate([[0], np.cumsum(spelled.lengths[tokens])])[np.concatenate([[0], np.cumsum(n)])]
            for i in np.flatnonzero(ok):
                own = said[at[i]:at[i + 1]]
                ok[i] = len(own) == borders[i + 1] - borders[i] + 1 and own[0] == 32 and np.array_equal(own[1:], body[borders[i]:borders[i + 1]])
            mute = np.flatnonzero(spelled.lengths[tokens] == 0)  # a token without bytes ends nowhere
            ok[np.searchsorted(np.cumsum(n), mute, "right")] = False
        if not ok.all():
            sides = [t[np.repeat(ok, n)] for t, n in zip(sides, count)]
            count = [np.where(ok, n, 0) for n in count]
        numbers, per_doc = self.window_numbers(*sides, *count)
        self.windows.append(numbers.astype("<u4"))
        self.size += len(numbers)
        at = np.concatenate([[0], np.cumsum(per_doc)])
        groups = np.diff(np.concatenate([[0], np.cumsum(np.array(self.groups, np.int64)[numbers])])[at]) if len(numbers) else np.zeros(len(ids), np.int64)
        each, named = self.texts, numbers.tolist()
        for i, doc in enumerate(ids):
            digest = hashlib.sha256(b"".join([each[w] for w in named[at[i]:at[i + 1]]])[:-1]).hexdigest() if ok[i] else ""
            self.rows.append((doc, int(count[0][i]), int(count[1][i]), int(groups[i]), digest, int(per_doc[i])))

    def window_numbers(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The window at each place of all documents, and how many each document has."""
        if not len(a):
            return np.zeros(0, np.int64), np.zeros(len(n_a), np.int64)
        ends_a, ends_b = np.cumsum(self.both.a.lengths[a]), np.cumsum(self.both.b.lengths[b])
        ending = np.zeros(ends_a[-1] + 1, np.int8)
        ending[ends_a] += 1
        ending[ends_b] += 1
        i, j = np.flatnonzero(ending[ends_a] == 2) + 1, np.flatnonzero(ending[ends_b] == 2) + 1  # tokens up to each shared end
        document = np.cumsum(n_a)
        next_a, next_b = np.append(self.both.a.spaced[a], False), np.append(self.both.b.spaced[b], False)
        last = np.zeros(len(a) + 1, bool)
        last[document] = True
        anchor = np.flatnonzero(last[i] | next_a[i] & next_b[j])
        i, j = np.concatenate([[0], i]), np.concatenate([[0], j])
        g = np.concatenate([[0], anchor + 1])  # groups up to each anchor
        from_a, from_b, size_a, size_b = i[g[:-1]], j[g[:-1]], np.diff(i[g]), np.diff(j[g])
        hash_a, hash_b = span_hash(prefixes(a), from_a, from_a + size_a), span_hash(prefixes(b), from_b, from_b + size_b)
        _, first, same = np.unique(mix(hash_a ^ mix(hash_b + U64(1))), return_index=True, return_inverse=True)
        place = first[same]
        equal = (size_a == size_a[place]).all() and (size_b == size_b[place]).all()
        equal = equal and (a == a[gathered(from_a[place], size_a)]).all() and (b == b[gathered(from_b[place], size_b)]).all()
        chosen = first if equal else np.arange(len(size_a))  # every window by itself, should two hashes agree by chance
        tuples, at = two_sides(a, from_a[chosen], size_a[chosen], b, from_b[chosen], size_b[chosen], gap=1)
        body, at = tuples.astype("<i4").tobytes(), (4 * at).tolist()
        known, named, new = self.known, [], []
        for k in range(len(chosen)):
            key = body[at[k]:at[k + 1]]
            number = known.get(key)
            if number is None:
                number = known[key] = len(known)
                new.append(k)
            named.append(number)
        self.learn(a, b, i, j, g[chosen[new]], g[chosen[new] + 1])
        numbers = np.array(named, np.int64)
        return numbers[same] if equal else numbers, np.diff(np.searchsorted(i[g[1:]], np.concatenate([[0], document]), "right"))

    def learn(self, a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Align new windows, which hold the groups ``low`` to ``high`` each; ``i``, ``j``: tokens before each group."""
        if not len(low):
            return
        count = high - low
        group = gathered(low, count)
        n_a, n_b = i[group + 1] - i[group], j[group + 1] - j[group]
        pairs, inverse = np.unique(a[i[group + 1] - 1] << 32 | b[j[group + 1] - 1], return_inverse=True)
        pair_no = self.pair_no
        numbers = np.array([pair_no.setdefault(x, len(pair_no)) for x in pairs.tolist()], np.int64)
        self.pairs.append(numbers[inverse])
        self.groups += count.tolist()
        tokens, at = two_sides(a, i[group], n_a, b, j[group], n_b)
        text = self.both.decimal.spell(tokens).copy()
        ends = np.cumsum(self.both.decimal.lengths[tokens])
        text[ends[at[:-1] + n_a - 1] - 1] = ord("|")
        text[ends[at[1:] - 1] - 1] = ord(";")
        body, until = text.tobytes(), ends[at[np.cumsum(count)] - 1].tolist()
        self.texts += [body[x:y] for x, y in zip([0, *until[:-1]], until)]

    def row(self, name: int) -> pa.RecordBatch:
        sizes = np.array(self.groups, np.int64)
        windows = np.concatenate(self.windows).astype(np.int64) if self.windows else np.zeros(0, np.int64)
        pairs = np.concatenate(self.pairs) if self.pairs else np.zeros(0, np.int64)
        times = np.bincount(pairs, np.repeat(np.bincount(windows, minlength=len(sizes)), sizes), len(self.pair_no)).astype(np.int64)
        codes = np.fromiter(self.pair_no, np.int64, len(self.pair_no))
        doc_ids, n_a, n_b, groups, digests, per_doc = (list(x) for x in zip(*self.rows))
        values = {"chunk": name, "doc_ids": doc_ids, "n_a": n_a, "n_b": n_b, "n_groups": groups, "groups_sha256": digests, "per_doc": per_doc, "windows": planes(windows), "sizes": planes(sizes), "pairs": planes(pairs),
                  "a": codes >> 32, "b": codes & 0xFFFFFFFF, "n": times}
        return pa.RecordBatch.from_pylist([values], schema=FIELDS)


FIELDS = pa.schema([("chunk", pa.int64()), *((c, pa.list_(pa.int64())) for c in ("doc_ids", "n_a", "n_b", "n_groups")), ("groups_sha256", pa.list_(pa.string())), ("per_doc", pa.list_(pa.int64())),
                    ("windows", pa.binary()), ("sizes", pa.binary()), ("pairs", pa.binary()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("n", pa.list_(pa.int64()))])


def chunked(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str, windows: int, different: int) -> Iterator[pa.RecordBatch]:
    both = both_of(path_a, path_b)
    name, chunk = TaskContext.get().partitionId() << 32, Chunk(both)
    for batch in batches:
        body, borders = utf8(batch["text"])
        ids = batch["doc_id"].to_pylist()
        for low, high in portions(borders, PORTION):
            chunk.add(ids[low:high], batch["text"].slice(low, high - low).to_pylist(), body[borders[low]:borders[high]], borders[low:high + 1] - borders[low])
            if chunk.size >= windows or len(chunk.known) >= different:
                yield chunk.row(name)
                name, chunk = name + 1, Chunk(both)
    if chunk.rows:
        yield chunk.row(name)


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with the sums over their links, from a chunk and its pairs' counts."""
    def totals(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], np.cumsum(counts)])])

    for batch in batches:
        for row in range(batch.num_rows):
            get = lambda c: batch[c][row]
            windows, sizes, pairs = (from_planes(get(c).as_py()) for c in ("windows", "sizes", "pairs"))
            per_doc, sums = get("per_doc").values.to_numpy(), []
            for name in ("best", "total"):
                of_pair = np.zeros(int(pairs.max(initial=-1)) + 1, np.int64)
                if get("at").is_valid:
                    of_pair[get("at").values.to_numpy()] = get(name).values.to_numpy()
                sums.append(pa.array(totals(totals(of_pair[pairs], sizes)[windows], per_doc)))
            links = get("n_groups").values  # one token of either side ends at a shared end
            yield pa.RecordBatch.from_arrays([get("doc_ids").values, get("n_a").values, get("n_b").values, links, links, *sums, get("groups_sha256").values],
                                             names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``a, b, total, best``: how often each pair is linked, and whether no other ``a`` is linked with ``b`` more often."""
    each = chunks.select(F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select("p.a", "p.b", "p.n")
    totals = each.groupBy("a", "b").agg(F.sum("n").alias("total"))
    return totals.withColumn("best", F.col("total") == F.max("total").over(Window.partitionBy("b")))


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", windows: int = WINDOWS, different: int = DIFFERENT) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    with batches_of(spark, 8 << 20):
        chunks = written(rows.mapInArrow(partial(chunked, path_a=path_a, path_b=path_b, windows=windows, different=different), CHUNKS), "chunks")
        counts = written(pair_counts(chunks), "pairs")
        each = chunks.select("chunk", F.posexplode(F.arrays_zip("a", "b")).alias("at", "p")).select("chunk", "at", F.col("p.a").alias("a"), F.col("p.b").alias("b"))
        each = each.join(counts, ["a", "b"]).groupBy("chunk").agg(F.collect_list(F.struct("at", F.col("best").cast("long").alias("best"), "total")).alias("v"))  # a chunk's different pairs are bounded
        back = each.select("chunk", F.col("v.at").alias("at"), F.col("v.best").alias("best"), F.col("v.total").alias("total"))
        return written(chunks.drop("a", "b", "n").join(back, "chunk", "left").drop("chunk").mapInArrow(summed, DOCUMENTS), "aligned")


def op12_alignment(spark: SparkSession, sf_dir: str, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """All documents, in a byte-level and a piece vocabulary."""
    import public_tokenizers

    path_a, path_b = path_a or public_tokenizers.path("byte_bpe_50k.json"), path_b or public_tokenizers.path("piece_bpe_32k.model")
    return align(table(spark, sf_dir, "documents"), path_a, path_b)
