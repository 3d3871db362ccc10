"""Best-fit packing of tokenized documents into fixed-length sequences.

Bounded-space online best fit. Each task streams its documents through a fixed
number of open bins. The free spaces that occur are the set bits of one
integer, so the tightest bin that fits is one shift and one lowest-bit away.
When a new bin is needed and all places are taken, the fullest open bin
closes. A task holds the open bins and one Arrow batch, nothing else; tasks
need no exchange, and a lost task is redone alone with the same result.

Defined cases: a null text is an empty one and gives one piece with the end
id; repeated rows are packed each; null ids are kept; empty tables give no
rows; other columns are ignored; texts longer than a sequence are cut, with
the odd length first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import give_back

#: White space as Python sees it (a superset of any tokenizer's), for RE2.
SPACE = r"\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
CUT = "\x00"
SLICE_BYTES = 12_000_000


class WordEncoder:
    """Ids of many texts, each distinct part of them encoded once.

    For byte-level BPE with the usual pattern (runs of letters, digits or
    signs with at most one blank before, runs of white space). Such a
    tokenizer splits a text before every blank that follows a character other
    than white space, at a lone line feed between two words, and between
    letters and the signs after them, so the ids of a text are those of its
    parts cut there. Parts are numbered by Arrow, the distinct ones encoded
    many in one call, and the ids of the texts gathered from them.
    """

    SIGNS = r"[.,!?;:%$&*#|)(\"\[\]]"

    def __init__(self, tokenizer, plain=None) -> None:
        """``tokenizer`` takes the parts, ``plain`` (by default the same) the
        whole texts that hold an added token."""
        self.tokenizer, self.plain = tokenizer, plain or tokenizer
        self.added = [] if self.plain.encode_special_tokens else [t.content for t in self.plain.get_added_tokens_decoder().values()]
        vocab = tokenizer.get_vocab()
        self.starts = np.zeros(max(vocab.values()) + 1, bool)
        self.starts[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True
        self.feed = np.array(self.ids(["\n"], "")[0], "<u4")

    def ids(self, parts: list[str], lead: str) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([lead + p for p in parts], add_special_tokens=False)]

    def units(self, parts: list[str], lead: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids and lengths of parts without white space: one call for many, cut
        at leading blanks or at the line feeds between."""
        flat, sizes = [], []
        for k in range(0, len(parts), 20_000):
            some = parts[k:k + 20_000]
            ids = np.array(self.ids([lead + lead.join(some) if lead else "\n".join(some)], "")[0], "<u4")
            if lead:
                at = np.flatnonzero(self.starts[ids])
                size = np.diff(np.r_[at, len(ids)])
            else:
                feeds = np.flatnonzero(ids == self.feed[0]) if len(self.feed) == 1 else np.zeros(0, int)
                at = np.r_[0, feeds + 1]
                size = np.diff(np.r_[at, len(ids) + 1]) - 1
                ids = np.delete(ids, feeds)
            if len(at) != len(some):
                alone = self.ids(some, lead)
                ids, size = np.array([i for e in alone for i in e], "<u4"), np.array([len(e) for e in alone])
            flat.append(ids)
            sizes.append(size)
        return flat, sizes

    def segments(self, words: pa.Array, first: np.ndarray, later: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(table, ids, lengths): up to four numbered units for each distinct word.

        ``table`` has a row per word as the first of a text, then one per word
        after a blank; -1 stands for no unit.
        """
        n = len(words)
        plain = f"[^{SPACE}]+"
        pair = pc.match_substring_regex(words, f"^{plain}\n{plain}$").to_numpy(zero_copy_only=False)
        single = ~(pair | pc.match_substring_regex(words, f"^{plain}$").to_numpy(zero_copy_only=False))
        fields = pc.extract_regex(words, f"^(?P<a>{plain})(?:\n(?P<b>{plain}))?$")
        a, b = pc.fill_null(fields.field("a"), ""), pc.fill_null(fields.field("b"), "")
        cut = pc.extract_regex(a, rf"^(?P<w>\p{{L}}+)(?P<s>{self.SIGNS}*)$")
        alpha = pc.is_valid(cut)
        base = pc.if_else(alpha, cut.field("w"), a)
        signs = pc.if_else(alpha, cut.field("s"), "")
        table = np.full((2 * n, 4), -1, np.int64)
        flat, sizes, count = [], [], 0

        def add(parts: pa.Array, lead: str, at: np.ndarray, column: int) -> None:
            nonlocal count
            if len(parts):
                coded = parts.dictionary_encode()
                f, s = self.units(coded.dictionary.to_pylist(), lead)
                table[at, column] = coded.indices.to_numpy(zero_copy_only=False) + count
                flat.extend(f)
                sizes.extend(s)
                count += len(coded.dictionary)

        for use, lead, shift in ((first, "", 0), (later, " ", n)):
            own = np.flatnonzero(use & ~single)
            add(base.take(pa.array(own)), lead, own + shift, 0)
            alone = np.flatnonzero(use & single)
            for i, e in zip(alone, self.ids(words.take(pa.array(alone)).to_pylist(), lead)):
                table[i + shift, 0] = count
                flat.append(np.array(e, "<u4"))
                sizes.append(np.array([len(e)]))
                count += 1
        rows = np.flatnonzero(pc.and_(alpha, pc.not_equal(signs, "")).to_numpy(zero_copy_only=False))
        add(signs.take(pa.array(rows)), "", rows, 1)
        table[rows + n, 1] = table[rows, 1]
        rows = np.flatnonzero(pair)
        add(b.take(pa.array(rows)), "", rows, 3)
        table[rows, 2] = count
        table[rows + n, 2:] = table[rows, 2:]
        return table, np.concatenate([*flat, self.feed]), np.concatenate([*sizes, [len(self.feed)]])

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text (null: none), in order."""
        texts = pc.fill_null(texts, "")
        spaced = pc.match_substring_regex(texts, f"[{SPACE}] ")
        whole = pc.and_(spaced, pc.match_substring(texts, CUT))
        for token in self.added:  # recognised anywhere in a text, across its words
            whole = pc.or_(whole, pc.match_substring(texts, token))
        cut = pc.replace_substring_regex(texts.filter(spaced), f"([^{SPACE}]) ", f"\\1{CUT}")
        spaced, whole = spaced.to_numpy(zero_copy_only=False), whole.to_numpy(zero_copy_only=False)
        parts = [pc.split_pattern(texts.filter(pa.array(~spaced)), " "), pc.split_pattern(cut, CUT)]
        order = np.argsort(np.r_[np.flatnonzero(~spaced), np.flatnonzero(spaced)])
        lists = pa.concat_arrays(parts).take(pa.array(order))
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        n = len(coded.dictionary)
        offsets = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]
        codes += n
        codes[offsets[:-1]] -= n  # 0..n-1: first in a text; n..2n-1: after a blank
        used = np.zeros(2 * n, bool)
        used[codes] = True
        table, flat, sizes = self.segments(coded.dictionary, used[:n], used[n:])
        begins = np.cumsum(sizes) - sizes
        total = np.where(table >= 0, sizes[table], 0).sum(1)
        for a in range(0, len(lists), 500):
            b = min(a + 500, len(lists))
            own = codes[offsets[a]:offsets[b]]
            at = np.r_[0, np.cumsum(total[own])]
            units = table[own].ravel()
            units = units[units >= 0]
            size = sizes[units]
            ends = np.cumsum(size)
            data = flat[np.repeat(begins[units] - ends + size, size) + np.arange(at[-1])].tobytes()
            cuts = (at[offsets[a:b + 1] - offsets[a]] * 4).tolist()
            for i, (x, y) in enumerate(zip(cuts[:-1], cuts[1:]), a):
                yield np.array(self.plain.encode(texts[i].as_py(), add_special_tokens=False).ids, "<u4").tobytes() if whole[i] else data[x:y]


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` with about SLICE_BYTES of text each."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    number = np.cumsum(size.astype(np.int64)) // SLICE_BYTES
    starts = [0, *(np.flatnonzero(np.diff(number)) + 1), batch.num_rows]
    for a, b in zip(starts[:-1], starts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


class OpenBins:
    """Best fit over at most ``n_open`` open bins of ``capacity``."""

    def __init__(self, capacity: int, n_open: int, first_id: int) -> None:
        self.capacity, self.n_open, self.next_id = capacity, n_open, first_id
        self.spaces = 0
        self.by_space: dict[int, list[int]] = {}
        self.n = 0

    def _take(self, space: int) -> int:
        bins = self.by_space[space]
        out = bins.pop()
        if not bins:
            del self.by_space[space]
            self.spaces ^= 1 << space
        self.n -= 1
        return out

    def place(self, length: int) -> tuple[int, int]:
        """Bin id and offset for an item of 1 to ``capacity``."""
        fits = self.spaces >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            bin_id = self._take(space)
        else:
            if self.n >= self.n_open:
                self._take((self.spaces & -self.spaces).bit_length() - 1)
            space, bin_id = self.capacity, self.next_id
            self.next_id += 1
        left = space - length
        if left:
            self.by_space.setdefault(left, []).append(bin_id)
            self.spaces |= 1 << left
            self.n += 1
        return bin_id, self.capacity - space


def pieces_of(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: the odd length first, then full ones."""
    odd = length % capacity
    cuts = ([(0, odd)] if odd else []) + [(s, capacity) for s in range(odd, length, capacity)]
    return cuts


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
         n_open: int = 1024, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    ``with_ids`` adds the token ids themselves (array of int). Sequence ids
    are the task's number times 2**33 plus a counter.
    """
    from tokenizers import Tokenizer

    Tokenizer.from_file(tokenizer_path)  # a wrong file fails here, not in the tasks
    with open(tokenizer_path, encoding="utf-8") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = Tokenizer.from_str(held.value)
        tok.encode_special_tokens = True  # in single words, which are parts of texts without added tokens
        encoder = WordEncoder(tok, Tokenizer.from_str(held.value))
        bins = OpenBins(capacity, n_open, TaskContext.get().partitionId() << 33)
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            for part in slices(batch, 1):
                rows: dict[str, list] = {c: [] for c in ("row", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids")}
                for row, ids in enumerate(encoder.encode(part.column(1))):
                    ids += end
                    for piece, (start, length) in enumerate(pieces_of(len(ids) // 4, capacity)):
                        own = ids[start * 4:(start + length) * 4]
                        seq, offset = bins.place(length)
                        for c, v in (("row", row), ("piece", piece), ("start", start), ("length", length),
                                     ("ids_crc32", zlib.crc32(own)), ("sequence_id", seq), ("offset", offset)):
                            rows[c].append(v)
                        if with_ids:
                            rows["ids"].append([int.from_bytes(own[j:j + 4], "little") for j in range(0, len(own), 4)])
                cols = [part.column(0).take(pa.array(rows["row"], pa.int64())), pa.array(rows["piece"], pa.int32())]
                cols += [pa.array(rows[c], pa.int64()) for c in ("start", "length", "ids_crc32", "sequence_id", "offset")]
                names = ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
                if with_ids:
                    cols.append(pa.array(rows["ids"], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)
        give_back()

    schema = f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))
    return out.withColumnRenamed("id", id_col)
