"""SentencePiece encoding and decoding in numpy: batched merges by rank, or batched Viterbi.

The pieces and scores of a given model file are kept as sorted 64-bit substring hashes.  A
text gets a leading space, spaces become the piece mark, and it is cut into words where no
piece can reach over: before a space that follows another character, and around line breaks.
Words that were not seen before are grouped by length; all words of a length advance
together: the hashes of their substrings probe the sorted keys, and for each position the
best sum of scores over all pieces that end there is stored with its piece.  A character
without a piece costs more than any piece and becomes byte pieces, so decoding restores every
text exactly, a literal piece mark included.

The segmentation with the largest sum of scores is the unigram rule; ties go to the shorter
last piece.  A file whose scores are whole numbers holds merge ranks: there the two neighbours
whose union has the best rank are merged, the leftmost at a tie, until no union is a piece, one
merge at a time in each of the equally long words, which shorter ones are filled up to.  Words
longer than ``LONG``, or few of a length, keep their possible merges in a heap.  The ids are the library's, but for a literal piece mark, which the
library reads as a space.

Null and empty texts have no ids; a null stays null when it is decoded.  Repeated rows agree.
An empty table gives no rows.  Other columns are kept; a column named ``ids`` or ``n_tokens``
is replaced.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from eventlab.llm.common import U64, in_small_batches, mix, powers, table
from eventlab.llm.common import _BASE as BASE, _INVERSE as INVERSE

MARK = "▁"
LITERAL = "\U0010FFFF"  # stands for a piece mark in the text itself, which no piece holds
WORDS = re.compile(r"\n| *[^ \n]+| +")
CELLS = 1 << 15
LONG, FEW = 200, 8
FILL = "\udfff"  # behind a word in a batch; no text from a table holds it


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


class Pieces:
    """The vocabulary of a model file, with the words met so far (at most ``keep``)."""

    def __init__(self, path: str, keep: int = 300_000):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.keep, self.known = keep, {}
        every = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes = {}
        self.surface: list[bytes] = []
        usable = []
        for i, piece in enumerate(every):
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.surface.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.surface.append(b"")
            else:
                self.surface.append(piece.replace(MARK, " ").encode())
                if "\n" in piece or MARK in piece.lstrip(MARK):
                    raise ValueError(f"a piece reaches over a word border: {piece!r}")
                usable.append(i)
        self.byte_ids = np.array([self.bytes.get(b, model.unk_id()) for b in range(256)], "<u4")
        self.longest = max(len(every[i]) for i in usable)
        scores = np.array([model.get_score(i) for i in usable])
        self.unknown = scores[scores > -1e8].min() - 10.0
        keys = np.zeros(len(usable), U64)
        for size in range(1, self.longest + 1):
            at = [k for k, i in enumerate(usable) if len(every[i]) == size]
            if at:
                sums = self.sums(np.stack([codes(every[usable[k]]) for k in at]))
                keys[at] = self.hashes(sums, np.zeros(1, np.int64), size)[:, 0]
        self.ranked = bool((scores == np.round(scores)).all())
        order = np.argsort(keys)
        self.keys, self.scores, self.ids = keys[order], scores[order], np.array(usable)[order]

    @staticmethod
    def sums(words: np.ndarray) -> np.ndarray:
        out = np.zeros((len(words), words.shape[1] + 1), U64)
        np.cumsum(mix(words.astype(U64) + U64(1)) * powers(BASE, words.shape[1]), axis=1, out=out[:, 1:])
        return out

    @staticmethod
    def hashes(sums: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
        return mix((sums[:, begin + size] - sums[:, begin]) * powers(INVERSE, sums.shape[1])[begin] + U64(size))

    def segment(self, words: np.ndarray) -> list[bytes]:
        """Ids of equally long words, given as rows of code points."""
        count, length = words.shape
        sums = self.sums(words)
        best = np.full((count, length + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((count, length + 1), np.int16)
        piece = np.full((count, length + 1), -1, np.int32)
        width = max(1, CELLS // count)
        for low in range(1, length + 1, width):
            ends = np.arange(low, min(low + width, length + 1))
            value = np.full((self.longest, count, len(ends)), -np.inf)
            which = np.full((self.longest, count, len(ends)), -1, np.int32)
            for size in range(1, min(self.longest, int(ends[-1])) + 1):
                fit = ends >= size
                keys = self.hashes(sums, ends[fit] - size, size)
                at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
                hit = self.keys[at] == keys
                value[size - 1][:, fit] = np.where(hit, self.scores[at], self.unknown if size == 1 else -np.inf)
                which[size - 1][:, fit] = np.where(hit, self.ids[at], -1)
            for k, end in enumerate(ends):
                sizes = min(self.longest, int(end))
                total = value[:sizes, :, k].T + best[:, end - sizes:end][:, ::-1]
                take = total.argmax(axis=1)
                best[:, end] = total[np.arange(count), take]
                back[:, end] = take + 1
                piece[:, end] = which[take, np.arange(count), k]
        tokens = np.full((count, length), -2, np.int32)
        place, live = np.full(count, length), np.arange(count)
        while len(live):
            begin = place[live] - back[live, place[live]]
            tokens[live, begin] = piece[live, place[live]]
            place[live] = begin
            live = live[begin > 0]
        if (tokens != -1).all():
            return [row[row != -2].astype("<u4").tobytes() for row in tokens]
        return [self.spell(row, word) for row, word in zip(tokens, words)]

    def spell(self, row: np.ndarray, word: np.ndarray) -> bytes:
        """A segmentation in which some characters become byte pieces."""
        out = []
        for at in np.flatnonzero(row != -2):
            if row[at] >= 0:
                out.append(np.array([row[at]], "<u4"))
            else:
                char = chr(word[at]).replace(LITERAL, MARK).encode("utf-8", "surrogatepass")
                out.append(self.byte_ids[np.frombuffer(char, np.uint8)])
        return np.concatenate(out).astype("<u4").tobytes()

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word; words of one length go together."""
        by: dict[int, list[str]] = {}
        for word in words:
            by.setdefault(len(word), []).append(word)
        out = {}
        for size, same in by.items():
            step = max(1, CELLS // size)
            for at in range(0, len(same), step):
                some = same[at:at + step]
                rows = codes("".join(some).replace(" ", MARK)).reshape(len(some), size)
                out.update(zip(some, self.segment(rows)))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        parts = [WORDS.findall(" " + x.replace(MARK, LITERAL)) if x else [] for x in texts]
        met = set()
        for x in parts:
            met.update(x)
        missing = met.difference(self.known)
        if len(self.known) + len(missing) > self.keep:
            self.known, missing = {}, met
        self.known.update(self.learn(sorted(missing)))
        known = self.known
        return [b"".join([known[w] for w in x]) for x in parts]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; their bytes are joined before they are read as characters."""
        surface = self.surface
        return b"".join([surface[i] for i in ids.tolist()])[1:].decode("utf-8", "replace")


class Merges(Pieces):
    """The vocabulary of a model file whose scores are merge ranks."""

    def segment(self, words: np.ndarray) -> list[bytes]:
        count, length = words.shape
        sums = self.sums(words)
        if length > LONG:
            return [self.merged(word, row[None]) for word, row in zip(words, sums)]
        # By first character and size: rank and id of the piece there.
        score = np.full((count, length + 1, min(self.longest, length) + 1), -np.inf)
        which = np.full(score.shape, -1, np.int32)
        for size in range(1, score.shape[2]):
            score[:, :length - size + 1, size], which[:, :length - size + 1, size] = self.probe(sums, np.arange(length - size + 1), size)
        after = np.tile(np.arange(1, length + 2), (count, 1))  # the symbol behind that at a place, and before it
        before = np.tile(np.arange(-1, length), (count, 1))
        pair = score[:, :, 2].copy() if length > 1 else np.full((count, length + 1), -np.inf)
        live, top = np.arange(count), score.shape[2]

        def rank(rows: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
            fit = (end <= length) & (end - begin < top) & (begin >= 0)
            return np.where(fit, score[rows, begin, np.where(fit, end - begin, 0)], -np.inf)

        while len(live):
            at = pair[live].argmax(axis=1)
            go = pair[live, at] > -np.inf
            live, at = live[go], at[go]
            gone = after[live, at]
            behind = after[live, gone]
            after[live, at] = behind
            before[live, np.minimum(behind, length)] = at
            pair[live, gone] = -np.inf
            pair[live, at] = rank(live, at, after[live, np.minimum(behind, length)])
            ahead = before[live, at]
            some = ahead >= 0
            pair[live[some], ahead[some]] = rank(live[some], ahead[some], behind[some])
        tokens = np.full((count, length), -2, np.int32)
        live, at = np.arange(count), np.zeros(count, np.int64)
        while len(live):
            size = after[live, at] - at
            tokens[live, at] = which[live, at, size]
            at = at + size
            live, at = live[at < length], at[at < length]
        tokens[words == ord(FILL)] = -2
        held = tokens != -2
        flat, ends = tokens[held].astype("<u4").tobytes(), 4 * held.sum(axis=1).cumsum()
        out = [flat[i:j] for i, j in zip([0, *ends[:-1].tolist()], ends.tolist())]
        for k in np.flatnonzero((tokens == -1).any(axis=1)):
            out[k] = self.spell(tokens[k], words[k])
        return out

    def probe(self, sums: np.ndarray, begin: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and ids of the pieces of ``size`` characters at ``begin``."""
        keys = self.hashes(sums, begin, size)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        return np.where(hit, self.scores[at], -np.inf), np.where(hit, self.ids[at], -1)

    def merged(self, word: np.ndarray, sums: np.ndarray) -> bytes:
        """Ids of one long word."""
        length = len(word)
        found: list[dict[int, tuple[float, int]]] = [{}, *({} for _ in range(self.longest))]
        for size in range(1, min(self.longest, length) + 1):
            score, which = self.probe(sums, np.arange(length - size + 1), size)
            at = np.flatnonzero(which[0] >= 0)
            found[size] = dict(zip(at.tolist(), zip(score[0, at].tolist(), which[0, at].tolist())))
        after, before, heap = list(range(1, length + 1)), list(range(-1, length - 1)), []

        def offer(begin: int) -> None:
            if begin >= 0 and after[begin] < length:
                end = after[after[begin]]
                if end - begin <= self.longest and begin in found[end - begin]:
                    heapq.heappush(heap, (-found[end - begin][begin][0], begin, after[begin], end))

        for begin in range(length):
            offer(begin)
        while heap:
            _, begin, middle, end = heapq.heappop(heap)
            if after[begin] == middle and after[middle] == end:
                after[begin], after[middle] = end, -1
                if end < length:
                    before[end] = begin
                offer(begin)
                offer(before[begin])
        row, at = np.full(length, -2, np.int32), 0
        while at < length:
            row[at] = found[after[at] - at].get(at, (0.0, -1))[1]
            at = after[at]
        row[word == ord(FILL)] = -2
        return row[row != -2].astype("<u4").tobytes() if (row != -1).all() else self.spell(row, word)


_PIECES: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """One vocabulary per file and worker process."""
    if path not in _PIECES:
        model = Pieces(path)
        _PIECES[path] = Merges(path) if model.ranked else model
    return _PIECES[path]


def encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = pieces(path)
    for batch in batches:
        for at in range(0, max(batch.num_rows, 1), 200):
            some = batch.slice(at, 200)
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in model.encode([x or "" for x in some["_text"].to_pylist()])]
            sizes = np.array([len(x) for x in ids], np.int64)
            flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
            rows = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], sizes.cumsum()]).astype(np.int32)), flat)
            rest = [c for c in some.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays([*(some[c] for c in rest), pa.array(sizes), rows], names=[*rest, "n_tokens", "ids"])


def decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = pieces(path)
    for batch in batches:
        texts = [None if x is None else model.decode(np.array(x, np.int64)) for x in batch["ids"].to_pylist()]
        rest = [c for c in batch.schema.names if c != "ids"]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in rest), pa.array(texts, pa.string())], names=[*rest, "text"])


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _kinds(df: DataFrame, names: list[str]) -> str:
    return "".join(f"`{c}` {t}, " for c, t in df.select(*names).dtypes)


def encode(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """The other columns with ``n_tokens`` and ``ids``."""
    rest = [c for c in docs.columns if c not in (text, "ids", "n_tokens")]
    rows = docs.select(*rest, docs[text].alias("_text"))
    return in_small_batches(rows).mapInArrow(partial(encoded, path=model), _kinds(docs, rest) + "n_tokens long, ids array<int>")


def decode(rows: DataFrame, model: str) -> DataFrame:
    """The other columns with the ``text`` of ``ids``."""
    rest = [c for c in rows.columns if c not in ("ids", "text")]
    return rows.select(*rest, "ids").mapInArrow(partial(decoded, path=model), _kinds(rows, rest) + "text string")


def summarised(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = pieces(path)
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            some = batch.slice(at, 500)
            texts = [x or "" for x in some["text"].to_pylist()]
            ids = model.encode(texts)
            exact = [model.decode(np.frombuffer(x, "<u4")) == t for x, t in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays([some["doc_id"], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(exact)],
                                             names=["doc_id", "n_tokens", "ids_crc32", "round_trip"])


def op6_sentencepiece(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """Every text encoded and decoded: token count, checksum of the ids, and whether the text came back."""
    docs = in_small_batches(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.mapInArrow(partial(summarised, path=model or default_model()), "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean")


def both_ways(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Rows with their ids, and their text read back from these; a null stays null."""
    model = pieces(path)
    for batch in encoded(batches, path):
        ids = batch["ids"]
        flat, at = ids.flatten().to_numpy(), ids.offsets.to_numpy()
        at = at - at[0]
        texts = [None if null else model.decode(flat[a:b]) for null, a, b in zip(batch["_null"].to_pylist(), at[:-1], at[1:])]
        rest = [c for c in batch.schema.names if c not in ("_null", "n_tokens", "ids")]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in rest), pa.array(texts, pa.string()), batch["n_tokens"], ids], names=[*rest, "text", "n_tokens", "ids"])


def with_tokens(docs: DataFrame, model: str | None = None) -> DataFrame:
    """The documents with their ids, their text as decoded from these ids."""
    names = [c for c in docs.columns if c not in ("ids", "n_tokens")]
    rest = [c for c in names if c != "text"]
    rows = in_small_batches(docs.select(*rest, docs["text"].alias("_text"), docs["text"].isNull().alias("_null")))
    out = rows.mapInArrow(partial(both_ways, path=model or default_model()), _kinds(docs, rest) + "text string, n_tokens long, ids array<int>")
    return out.select(*names, "n_tokens", "ids")
