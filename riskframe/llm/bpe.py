"""Byte-level BPE encoding and decoding with a transducer lexicon.

``fit_encoder`` counts the pieces (pre-tokens) of all texts by a grouped sum
and compiles the ``max_words`` most frequent ones, with their ids, into a
minimal acyclic transducer: states with equal futures are one, so words share
suffixes as well as prefixes; a transition puts out a number, the numbers on a
word's path add up to its place in the lexicon, and the place leads to its ids.
The compiled arrays are one file in the shared folder that Spark hands to every
executor (``addFile``); tasks map it into memory and walk all distinct pieces
of a slice through it at once. Pieces that it does not hold are merged exactly:
always the pair of lowest rank, the leftmost of equals.

``encode_documents`` adds ``ids`` (binary: unsigned 32-bit integers, little
endian) and ``n_tokens``; ``decode_documents`` turns such ids back into text.

The tokenizer file must be a plain byte-level BPE (no normalizer, no dropout,
no unknown, prefix or suffix signs); others are refused. Its added tokens are
recognised in texts before anything else, as the library does by default. The
classes of letters, numbers and blanks are the library's: where the ``regex``
module's Unicode version has another class, the character is classed by asking
the library's pre-tokenizer.

Defined cases: null texts are empty, without ids; an id that the vocabulary
lacks decodes to nothing; bytes that are not UTF-8 decode to the replacement
character; texts of any length are whole; repeated rows are encoded each; an
empty table gives no rows; other columns pass through, but for ``ids``,
``n_tokens`` and ``decoded``, which are replaced.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import give_back, put_file, stored

SLICE = 4_000_000  # characters encoded together
MAX_WORDS = 131_072
LONGEST = 64  # bytes of a lexicon word, and of a word merged beside others
FAR = 1 << 40
#: The published pattern of this kind of tokenizer (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A character of each class that every Unicode version agrees on.
STAND_IN = {"L": "a", "N": "1", "O": "!", "S": "\t"}


def byte_signs() -> list[str]:
    """The sign that stands for each byte in the vocabulary: printable Latin-1
    characters stand for themselves, the others take the signs from 256 on."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def reclassed(spec: str) -> dict[int, str]:
    """Characters whose class the library sees otherwise than ``regex``, each
    with a stand-in of the right class."""
    from tokenizers import Tokenizer

    pieces = Tokenizer.from_str(spec).pre_tokenizer.pre_tokenize_str
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    now = dict.fromkeys(every, "O")
    for kind, pattern in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s")):
        now |= dict.fromkeys(regex.findall(pattern, every), kind)

    def python_class(c: str) -> str:
        kind = unicodedata.category(c)
        return kind[0] if kind[0] in "LN" else "S" if kind in ("Zs", "Zl", "Zp") or c in "\t\n\x0b\x0c\r\x85" else "O"

    def library_class(c: str) -> str:
        return next((k for k, before in (("L", "x"), ("N", "1"), ("O", "!")) if len(pieces(before + c)) == 1), "S")

    # two Unicode versions that agree on a character agree with those between them
    return {ord(c): STAND_IN[own] for c, kind in now.items() if python_class(c) != kind and (own := library_class(c)) != kind}


class Vocabulary:
    """What a tokenizer file says: merges, added tokens, bytes of every token."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            raw = f.read()
        spec = json.loads(raw)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                 and spec.get("normalizer") is None and (spec.get("decoder") or {}).get("type") == "ByteLevel"
                 and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
                 and not any(t.get(k) for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip")))
        signs = byte_signs()
        if not plain or any(s not in model["vocab"] for s in signs):
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        vocab = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.first = np.array([vocab[s] for s in signs], np.int64)  # id of each byte
        self.n = max([*vocab.values(), *self.added.values()]) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        key = np.array([vocab[a] * self.n + vocab[b] for a, b in pairs], np.int64)
        last = {k: i for i, k in enumerate(key.tolist())}  # of a repeated pair the last rank counts
        rank = np.array(sorted(last.values()), np.int64)
        order = rank[np.argsort(key[rank], kind="stable")]
        self.key, self.rank = key[order], order
        self.into = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        at = {s: b for b, s in enumerate(signs)}
        tokens = [b""] * self.n
        for token, i in (vocab | self.added).items():
            tokens[i] = bytes(at[c] for c in token) if all(c in at for c in token) else token.encode()
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_start = np.r_[0, np.cumsum([len(t) for t in tokens])]
        self.odd = reclassed(raw)
        self._pairs: dict[int, tuple[int, int]] | None = None

    def pairs(self) -> dict[int, tuple[int, int]]:
        """Rank and result by pair, for merging a single word; made once a task."""
        if self._pairs is None:
            self._pairs = dict(zip(self.key.tolist(), zip(self.rank.tolist(), self.into.tolist(), strict=True), strict=True))
        return self._pairs

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging two symbols; FAR if they don't merge."""
        if not len(self.key):
            return np.full(left.shape, FAR), np.zeros(left.shape, np.int64)
        want = left * self.n + right
        p = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        hit = (self.key[p] == want) & (left >= 0) & (right >= 0)
        return np.where(hit, self.rank[p], FAR), self.into[p]


def merge_short(vocab: Vocabulary, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after the other, number of each) for words of up
    to LONGEST bytes; each round merges one pair of every word."""
    width = int(size.max(initial=1))
    col = np.arange(width)
    sym = np.where(col < size[:, None], vocab.first[data[np.minimum(start[:, None] + col, len(data) - 1)]], -1)
    left = size.astype(np.int64).copy()
    out, todo = np.full(sym.shape, -1), np.arange(len(size))
    rank, into = vocab.ranks(sym[:, :-1], sym[:, 1:])
    while len(todo):
        best = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(todo), np.int64)
        row = np.arange(len(todo))
        more = rank[row, best] < FAR if rank.shape[1] else np.zeros(len(todo), bool)
        out[todo[~more], :sym.shape[1]] = sym[~more]
        todo, sym, rank, into, best = todo[more], sym[more], rank[more], into[more], best[more]
        if not len(todo):
            break
        row = np.arange(len(todo))
        sym[row, best] = into[row, best]
        # all behind the pair moves on by one
        take = col[: sym.shape[1] - 1] + (col[: sym.shape[1] - 1] > best[:, None])
        sym = np.take_along_axis(sym, take, axis=1)
        left[todo] -= 1
        pair = col[: sym.shape[1] - 1] + (col[: sym.shape[1] - 1] >= best[:, None])
        rank, into = np.take_along_axis(rank, pair, axis=1), np.take_along_axis(into, pair, axis=1)
        for place in (best - 1, best):
            ok = (place >= 0) & (place < sym.shape[1] - 1)
            r, p = row[ok], place[ok]
            rank[r, p], into[r, p] = vocab.ranks(sym[r, p], sym[r, p + 1])
    return out[out >= 0], left


def merge_long(vocab: Vocabulary, word: bytes) -> list[int]:
    """Ids of one word of any length, by a queue of pairs over a linked list."""
    sym = [int(vocab.first[b]) for b in word]
    after, before = [*range(1, len(sym)), -1], list(range(-1, len(sym) - 1))
    rank, into = (x.tolist() for x in vocab.ranks(np.array(sym[:-1], np.int64), np.array(sym[1:], np.int64)))
    pair = vocab.pairs()
    queue = [(r, i, sym[i], sym[i + 1], new) for i, (r, new) in enumerate(zip(rank, into, strict=True)) if r < FAR]
    heapq.heapify(queue)
    while queue:
        _, i, a, b, new = heapq.heappop(queue)
        j = after[i]
        if sym[i] != a or j < 0 or sym[j] != b:
            continue  # one of both was merged meanwhile
        sym[i], sym[j], after[i] = new, -1, after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for x in (before[i], i):
            if x >= 0 and after[x] >= 0 and (got := pair.get(sym[x] * vocab.n + sym[after[x]])):
                heapq.heappush(queue, (got[0], x, sym[x], sym[after[x]], got[1]))
    return [s for s in sym if s >= 0]


def merged(vocab: Vocabulary, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids one after the other, number of each word) of words in ``data``."""
    count = np.zeros(len(size), np.int64)
    groups = []
    for low, high in ((0, 8), (8, 16), (16, 32), (32, LONGEST)):
        own = np.flatnonzero((size > low) & (size <= high))
        for k in range(0, len(own), 50_000):
            at = own[k:k + 50_000]
            ids, n = merge_short(vocab, data, start[at], size[at])
            count[at] = n
            groups.append((at, ids, n))
    for i in np.flatnonzero(size > LONGEST):
        ids = merge_long(vocab, data[start[i]:start[i] + size[i]].tobytes())
        count[i] = len(ids)
        groups.append((np.array([i]), np.array(ids, np.int64), np.array([len(ids)])))
    out, first = np.zeros(int(count.sum()), np.int64), np.cumsum(count) - count
    for at, ids, n in groups:
        out[np.repeat(first[at] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
    return out, count


def transducer(words: list[bytes]) -> dict[str, np.ndarray]:
    """Minimal acyclic transducer of sorted distinct words.

    ``key`` holds state * 256 + byte of every transition in order, ``next`` its
    state, ``add`` the number it puts out; ``final`` marks states; ``root``.
    """
    known: dict[tuple, int] = {}
    size: list[int] = []  # words that can still follow a state
    path: list[tuple[list, bool]] = [([], False)]  # transitions and finality along the last word
    last = b""

    def freeze(down_to: int) -> None:
        while len(path) > down_to + 1:
            moves, final = path.pop()
            state = known.setdefault((final, tuple(moves)), len(known))
            if state == len(size):
                size.append(final + sum(size[s] for _, s in moves))
            path[-1][0].append((last[len(path) - 1], state))

    for word in words:
        same = next((i for i, (a, b) in enumerate(zip(word, last, strict=False)) if a != b), min(len(word), len(last)))
        freeze(same)
        path.extend(([], False) for _ in word[same:])
        path[-1] = (path[-1][0], True)
        last = word
    freeze(0)
    root = len(known)
    known[(path[0][1], tuple(path[0][0]), "root")] = root
    size.append(path[0][1] + sum(size[s] for _, s in path[0][0]))
    key, nxt, add = [], [], []
    for state, (final, moves, *_) in enumerate(known):
        number = int(final)
        for byte, to in moves:
            key.append(state * 256 + byte)
            nxt.append(to)
            add.append(number)
            number += size[to]
    final = np.array([k[0] for k in known], np.int64)
    return {"key": np.array(key, np.int64), "next": np.array(nxt, np.int64), "add": np.array(add, np.int64), "final": final, "root": np.array([root], np.int64)}


def walk(parts: dict[str, np.ndarray], data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Place in the lexicon of every word in ``data``; -1 where it has none."""
    state, place = np.full(len(size), int(parts["root"][0])), np.zeros(len(size), np.int64)
    todo = np.flatnonzero(size <= LONGEST) if len(parts["key"]) else np.zeros(0, np.int64)
    found = np.zeros(len(size), bool)
    step = 0
    while len(todo):
        ends = size[todo] == step
        found[todo[ends]] = parts["final"][state[todo[ends]]] == 1
        todo = todo[~ends]
        want = state[todo] * 256 + data[start[todo] + step]
        p = np.minimum(np.searchsorted(parts["key"], want), len(parts["key"]) - 1)
        hit = parts["key"][p] == want
        todo, p = todo[hit], p[hit]
        state[todo] = parts["next"][p]
        place[todo] += parts["add"][p]
        step += 1
    return np.where(found, place, -1)


NAMES = ("key", "next", "add", "final", "root", "first", "ids")


def packed(parts: dict[str, np.ndarray]) -> bytes:
    """Lengths, then the arrays, all 64-bit integers."""
    return b"".join([np.array([len(parts[n]) for n in NAMES], "<i8").tobytes(), *(parts[n].astype("<i8").tobytes() for n in NAMES)])


def mapped(path: str) -> dict[str, np.ndarray]:
    """The arrays of a lexicon file, mapped into memory."""
    whole = np.memmap(path, "<i8", "r")
    ends = len(NAMES) + np.cumsum(whole[: len(NAMES)])
    return {n: whole[e - k:e] for n, e, k in zip(NAMES, ends.tolist(), whole[: len(NAMES)].tolist(), strict=True)}


def words_in(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and sizes of the strings of an Arrow array."""
    at = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset:pieces.offset + len(pieces) + 1].astype(np.int64)
    data = np.frombuffer(pieces.buffers()[2] or b"\0", np.uint8)
    return data, at[:-1], np.diff(at)


class Encoder:
    """Vocabulary and lexicon of a session; travels to the tasks by value, the
    lexicon as a file."""

    def __init__(self, vocab: Vocabulary, lexicon: str | None) -> None:
        self.vocab, self.lexicon = vocab, lexicon

    def tools(self):
        """(splitter of a text into pieces, encoder of distinct pieces), in a task."""
        vocab = self.vocab
        plain = regex.compile(PATTERN)
        # one range first: most texts have nothing from the first reclassed character on
        far = re.compile(f"[{chr(min(vocab.odd))}-\U0010ffff]") if vocab.odd else None
        added = regex.compile("|".join(regex.escape(t) for t in sorted(vocab.added, key=len, reverse=True))) if vocab.added else None
        parts = mapped(SparkFiles.get(self.lexicon)) if self.lexicon else None

        def segment(text: str) -> list[str]:
            if far is None or not far.search(text) or vocab.odd.keys().isdisjoint(map(ord, set(text))):
                return plain.findall(text)
            return [text[m.start():m.end()] for m in plain.finditer(text.translate(vocab.odd))]

        def split(text: str) -> list[str]:
            if added is None or not added.search(text):
                return segment(text)
            out, at = [], 0
            for m in added.finditer(text):
                out += [*segment(text[at:m.start()]), m.group()]
                at = m.end()
            return out + segment(text[at:])

        def encode(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            """(ids one after the other, number of each piece)"""
            data, start, size = words_in(pieces)
            place = walk(parts, data, start, size) if parts else np.full(len(size), -1)
            ids, first, count = [], np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            if parts:
                hit = place >= 0
                first[hit] = parts["first"][place[hit]]
                count[hit] = parts["first"][place[hit] + 1] - first[hit]
                ids.append(parts["ids"])
            rest = np.flatnonzero(place < 0)
            got, n = merged(vocab, data, start[rest], size[rest])
            first[rest], count[rest] = sum(map(len, ids)) + np.cumsum(n) - n, n
            ids.append(got)
            if vocab.added:
                for i, text in enumerate(vocab.added):
                    at = pa.compute.index(pieces, text).as_py()
                    if at >= 0:
                        first[at], count[at] = sum(map(len, ids)) + i, 1
                ids.append(np.array(list(vocab.added.values()), np.int64))
            flat = np.concatenate(ids) if len(ids) > 1 else ids[0]
            return flat[np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))], count

        return split, encode


def slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of the batches with about SLICE characters, and their texts."""
    for batch in batches:
        size = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(size, (size[begin - 1] if begin else 0) + SLICE)))
            part = batch.slice(begin, end - begin)
            yield part, [t or "" for t in part.column(column).to_pylist()]
            begin = end
    give_back()


def piece_counts(docs: DataFrame, encoder: Encoder, text_col: str) -> DataFrame:
    """(piece, n) over all texts, added tokens and pieces over LONGEST bytes left out."""
    def summed(tables: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(tables).group_by("piece").aggregate([("n", "sum")]).rename_columns(["piece", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, _ = encoder.tools()
        held: list[pa.Table] = []
        for _, texts in slices(batches, 0):
            counted = pa.array([p for t in texts for p in split(t)], pa.string()).value_counts()
            held.append(pa.table({"piece": counted.field(0), "n": counted.field(1)}))
            if len(held) > 1 and sum(map(len, held)) > 500_000:
                held = [summed(held)]
                if len(held[0]) > 400_000:
                    yield from held.pop().to_batches(max_chunksize=50_000)
        if held:
            yield from summed(held).to_batches(max_chunksize=50_000)

    rows = docs.select(F.col(f"`{text_col}`").alias("text")).where("text <> ''").mapInArrow(run, "piece string, n bigint")
    rows = rows.where(F.octet_length("piece") <= LONGEST)
    if encoder.vocab.added:
        rows = rows.where(~F.col("piece").isin(*encoder.vocab.added))
    return rows.groupBy("piece").agg(F.sum("n").alias("n"))


def fit_encoder(docs: DataFrame, path: str, text_col: str = "text", max_words: int = MAX_WORDS) -> Encoder:
    """Encoder of the tokenizer file ``path`` with the lexicon of ``docs``.

    The most frequent pieces of at most 64 bytes, ``max_words`` at most, reach
    the driver, which compiles them; 0 makes none. Pieces are cut off between
    steps of frequency (16 to a doubling), so that no task sends more than is
    taken; pieces that occur once are never taken.
    """
    vocab = Vocabulary(path)
    bare = Encoder(vocab, None)
    if not max_words:
        return bare
    step = F.floor(F.log2("n") * 16).cast("int")
    counts = stored(piece_counts(docs, bare, text_col).where("n > 1").select("piece", step.alias("step")))
    least, taken = 1 << 30, 0
    for r in sorted(counts.groupBy("step").agg(F.count(F.lit(1)).alias("k")).collect(), reverse=True):  # at most 16 * 63 steps
        taken += r["k"]
        if taken > max_words:
            break
        least = r["step"]
    top = counts.where(F.col("step") >= least).select("piece").collect()
    words = sorted(r["piece"].encode() for r in top)
    size = np.array([len(w) for w in words], np.int64)
    ids, count = merged(vocab, np.frombuffer(b"".join(words) or b"\0", np.uint8), np.cumsum(size) - size, size)
    parts = transducer(words) | {"first": np.r_[0, np.cumsum(count)], "ids": ids}
    return Encoder(vocab, put_file(docs.sparkSession, packed(parts), "lexicon"))


def encode_documents(docs: DataFrame, encoder: Encoder, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (binary) and ``n_tokens`` of the whole texts."""
    docs = docs.drop("ids", "n_tokens")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, encode = encoder.tools()
        for part, texts in slices(batches, at):
            pieces, sizes = [], []
            for t in texts:
                own = split(t)
                pieces += own
                sizes.append(len(own))
            coded = pa.array(pieces, pa.string()).dictionary_encode()
            del pieces, texts
            flat, count = encode(coded.dictionary)
            which = coded.indices.to_numpy()
            first, n = (np.cumsum(count) - count)[which], count[which]
            ends = np.r_[0, np.cumsum(n)]
            ids = flat[np.repeat(first - ends[:-1], n) + np.arange(ends[-1])].astype("<u4")
            tokens = np.diff(ends[np.r_[0, np.cumsum(sizes)]])
            offsets = (4 * np.r_[0, np.cumsum(tokens)]).astype(np.int32)
            binary = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ids.tobytes())])
            yield pa.RecordBatch.from_arrays([*part.columns, binary, pa.array(tokens, pa.int64())], names=[*part.schema.names, "ids", "n_tokens"])

    from pyspark.sql import types as T

    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())])
    return docs.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, encoder: Encoder, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text of the ids; null ids: empty."""
    from pyspark.sql import types as T

    encoded = encoded.drop("decoded")
    at = encoded.columns.index(ids_col)
    start, data = encoder.vocab.token_start, encoder.vocab.token_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part, out = batch.slice(k, 500), []
                for raw in part.column(at).to_pylist():
                    ids = np.frombuffer(raw or b"", "<u4").astype(np.int64)
                    ids = ids[ids < len(start) - 1]
                    n = start[ids + 1] - start[ids]
                    ends = np.cumsum(n)
                    own = data[np.repeat(start[ids] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)]
                    out.append(own.tobytes().decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.string())], names=[*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))
