"""Spelling variants: words one edit apart, found by PartEnum signatures.

A word is taken as the multiset of its letters, that is a binary vector over
(letter, occurrence). One inserted or deleted letter changes one place of the
vector, a replaced one two, so near words have vectors within Hamming distance
two. The places are dealt to ``PARTS`` parts by the letters' frequency; two
vectors within distance two agree on all but two parts at least, so a word has
one signature for every choice of ``PARTS - 2`` parts, and near words share
one. Signatures meet by a shuffle (the equi-join); each task verifies all
candidates of its signatures together: words with one place blanked (replaced
letter) or one letter left out (inserted letter) are sorted, and what meets
there is compared code point by code point. A pair is reported only under the
first signature that both words share, so nothing needs a later distinct.
Signatures of more than ``split`` words are dealt further by the blanked words,
so that one signature does not stay in one task. Work is linear in the rows of
a signature; pairs of words are never enumerated.

Words come from whole texts: maximal runs ``[A-Za-z\\u00C0-\\u00FF]+``, A to Z
lower-cased, with the contract's keyed deletion (see ``own_words``).

Defined cases: null and empty texts have no words; a null id is an empty
string in the key of the deletion; repeated rows count again; words of any
length are whole; equally frequent near words: the smallest in code-point order
is the form; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import broadcast_if_small, give_back, mix64, portions, stored

PARTS = 5
KEYS = list(combinations(range(PARTS), PARTS - 2))  # the parts of each signature
HELD = 200_000  # words that a counting task holds before it hands them on
CHUNK = 100_000  # rows verified together
SPLIT = 50_000
STEP = 0x9E3779B97F4A7C15 | 1
#: Latin-1 bytes: A-Z to a-z, letters as they are, all else a blank.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def own_words(doc_id: str, text: str, least: int) -> Counter:
    """Words (Latin-1 bytes) of one text with their numbers of occurrences.

    ``h`` is the crc32 of ``<doc_id>:<run>``; if 31 divides it, the run loses
    its code point ``h % length``. Shorter results than ``least`` are left out.
    """
    runs = Counter(w for w in text.encode("latin-1", "replace").translate(LETTERS).split(b" ") if len(w) >= least)
    start = zlib.crc32(f"{doc_id}:".encode())
    out: Counter = Counter()
    for w, n in runs.items():
        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
        if h % 31 == 0:
            w = w[: h % len(w)] + w[h % len(w) + 1:]
            if len(w) < least:
                continue
        out[w] += n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7, at_least: int = 2) -> DataFrame:
    """(word, n) over all texts, words with ``at_least`` occurrences."""
    def flush(held: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in portions(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.update(own_words(doc, text, least))
                if len(held) > HELD:
                    yield flush(held)
                    held.clear()
        if held:
            yield flush(held)

    texts = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text_col}`").alias("text"))
    parts = texts.where(F.length("text") >= least).mapInArrow(run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= at_least)


class Flat:
    """Words as one array of code points, with what belongs to each of them."""

    def __init__(self, words: pa.Array) -> None:
        raw = words.cast(pa.string()).to_pylist()
        self.size = np.fromiter(map(len, raw), np.int64, len(raw))
        self.code = np.frombuffer("".join(raw).encode("utf-32-le"), np.uint32).astype(np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.row = np.repeat(np.arange(len(raw)), self.size)
        self.pos = np.arange(len(self.code)) - self.start[self.row]

    def summed(self, values: np.ndarray) -> np.ndarray:
        """Per word, with wrapping; words are never empty."""
        return np.add.reduceat(values, self.start) if len(values) else values[:0]

    def parts(self, ranks: dict[int, int]) -> np.ndarray:
        """Hash of each word's places in every part: (words, PARTS)."""
        order = np.lexsort((self.code, self.row))
        code, row = self.code[order], self.row[order]
        new = np.r_[True, (code[1:] != code[:-1]) | (row[1:] != row[:-1])] if len(code) else np.zeros(0, bool)
        begins = np.flatnonzero(new)
        nth = np.arange(len(code)) - begins[np.cumsum(new) - 1] if len(code) else code
        top = max(ranks) + 1 if ranks else 1
        rank = np.zeros(top, np.int64)
        for c, r in ranks.items():
            rank[c] = r
        part = (rank[code] + nth) % PARTS
        place = mix64((code << 32) + nth, 3)
        out = np.zeros((len(self.size), PARTS), np.uint64)
        for p in range(PARTS):
            out[:, p] = self.summed(np.where(part == p, place, np.uint64(0)))
        return out

    def blanked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of each word, of each word with one place blanked, and with one
        letter left out (0 where leaving out the letter before gives the same)."""
        with np.errstate(over="ignore"):
            most = int(self.size.max(initial=0))
            power = np.cumprod(np.r_[np.uint64(1), np.full(most + 1, STEP, np.uint64)])
            letter = mix64(self.code, 5)
            here, before = letter * power[self.pos + 1], letter * power[self.pos]
            total = self.summed(here)
            upto, shifted = np.cumsum(here), np.cumsum(before)
            base, end = upto[self.start] - here[self.start], self.start + self.size - 1
            blank = mix64(total[self.row] - here, 7) ^ mix64(self.pos, 11)
            left_out = (upto - here - base[self.row]) + (shifted[end][self.row] - shifted)
            same = np.r_[False, (self.code[1:] == self.code[:-1]) & (self.row[1:] == self.row[:-1])]
            return mix64(total, 13), blank, np.where(same, np.uint64(0), mix64(left_out, 13))


def signatures(words: DataFrame, ranks: dict[int, int]) -> DataFrame:
    """(sig, combo, word, n): one row per word and signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 20_000):
                own = batch.slice(k, 20_000)
                hashes = Flat(own.column(0)).parts(ranks)
                for i, keys in enumerate(KEYS):
                    sig = np.full(own.num_rows, i, np.uint64)
                    for p in keys:
                        sig = mix64(sig + hashes[:, p], p)
                    yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(np.full(own.num_rows, i, np.int32)), own.column(0), own.column(1)],
                                                     names=["sig", "combo", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "sig bigint, combo int, word string, n bigint")


def dealt_by_blanks(rows: DataFrame) -> DataFrame:
    """Rows of large signatures, once for every slice that holds one of their
    blanked words: near words share a blanked word, so they meet in a slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 20_000):
                own = batch.slice(k, 20_000)
                flat, slices = Flat(own.column(2)), own.column(4).to_numpy().astype(np.uint64)
                whole, blank, left_out = flat.blanked()
                key = np.concatenate([whole, blank, left_out[left_out != 0]])
                row = np.concatenate([np.arange(own.num_rows), flat.row, flat.row[left_out != 0]])
                at = np.unique(np.stack([row, (key % slices[row]).astype(np.int64)]), axis=1)
                got = own.take(pa.array(at[0]))
                yield pa.RecordBatch.from_arrays([*got.columns, pa.array(at[1])], names=["sig", "combo", "word", "n", "slices", "slice"])

    return rows.mapInArrow(run, "sig bigint, combo int, word string, n bigint, slices bigint, slice bigint")


def verified(rows: pa.Table, ranks: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (a, b) of the near words among rows of equal signature, each
    pair once over all signatures and slices: under its first signature, in the
    slice of what both have in common."""
    flat = Flat(rows.column("word").combine_chunks())
    slices, part = (rows.column(c).to_numpy().astype(np.uint64) for c in ("slices", "slice"))
    own = mix64(rows.column("sig").to_numpy().view(np.uint64), 17)
    whole, blank, left_out = flat.blanked()
    a, b = [], []
    here = blank % slices[flat.row] == part[flat.row]
    key, row = (blank ^ own[flat.row])[here], flat.row[here]
    order = np.argsort(key, kind="stable")
    key, row = key[order], row[order]
    step = 1
    while len(key) > step:  # runs are no longer than the alphabet, but for equal hashes
        hit = np.flatnonzero(key[step:] == key[:-step])
        if not len(hit):
            break
        a.append(row[hit])
        b.append(row[hit + step])
        step += 1
    some = (left_out != 0) & (left_out % slices[flat.row] == part[flat.row])
    key, longer = left_out[some] ^ own[flat.row[some]], flat.row[some]
    whole = whole ^ own
    order = np.argsort(whole, kind="stable")
    first, last = np.searchsorted(whole[order], key), np.searchsorted(whole[order], key, "right")
    for k in range(int((last - first).max(initial=0))):
        hit = np.flatnonzero(first + k < last)
        a.append(longer[hit])
        b.append(order[first[hit] + k])
    if not a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(a), np.concatenate(b)
    sig, combo = rows.column("sig").to_numpy(), rows.column("combo").to_numpy()
    ok = (sig[a] == sig[b]) & (part[a] == part[b])
    a, b = a[ok], b[ok]
    parts = flat.parts(ranks)
    agree = parts[a] == parts[b]
    first = np.full(len(a), -1)
    for i in reversed(range(len(KEYS))):
        first[agree[:, KEYS[i]].all(axis=1)] = i
    ok = first == combo[a]
    a, b = a[ok], b[ok]
    ok = one_apart(flat, a, b)
    pair = np.unique(np.stack([np.minimum(a[ok], b[ok]), np.maximum(a[ok], b[ok])]), axis=1)
    return pair[0], pair[1]


def one_apart(flat: Flat, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a and b differ by exactly one edit, by comparing them."""
    longer, shorter = np.where(flat.size[a] >= flat.size[b], a, b), np.where(flat.size[a] >= flat.size[b], b, a)
    size = flat.size[shorter]
    gap = flat.size[longer] - size
    at = np.repeat(np.arange(len(a)), size)
    pos = np.arange(len(at)) - (np.cumsum(size) - size)[at]
    one, two = flat.start[longer][at] + pos, flat.start[shorter][at] + pos
    code = np.concatenate([flat.code, [0]])
    plain, moved = code[one] == code[two], code[one + 1] == code[two]

    def first_miss(equal: np.ndarray, back: bool) -> np.ndarray:
        out = np.full(len(a), -1) if back else size.copy()
        miss = np.flatnonzero(~equal)
        if back:
            out[at[miss]] = pos[miss]  # the last one stays
        else:
            out[at[miss[::-1]]] = pos[miss[::-1]]
        return out

    head = first_miss(plain, False)
    replaced = (gap == 0) & (np.bincount(at, ~plain, minlength=len(a)) == 1)
    inserted = (gap == 1) & (first_miss(moved, True) < head)
    return replaced | inserted


def near_words(words: DataFrame, split: int = SPLIT) -> DataFrame:
    """(word, n, near, near_n) of a (word, n) table of distinct words, both ways."""
    spark = words.sparkSession
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").groupBy("c").agg(F.count(F.lit(1)).alias("k"))
    # the alphabet: at most 90 letters of the runs' class
    ranks = {ord(r["c"]): i for i, r in enumerate(letters.orderBy(F.desc("k"), "c").collect())}
    rows = signatures(words, ranks)
    large = stored(rows.groupBy("sig").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > split)
                   .select("sig", F.ceil(F.col("k") / split).alias("slices")))
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if large.isEmpty():
        rows = rows.withColumn("slices", F.lit(1).cast("bigint")).withColumn("slice", F.lit(0).cast("bigint"))
    else:
        rows = rows.join(broadcast_if_small(large), "sig", "left").select("sig", "combo", "word", "n", "slices")
        rows = (rows.where("slices is null").withColumn("slices", F.lit(1).cast("bigint")).withColumn("slice", F.lit(0).cast("bigint"))
                .unionByName(dealt_by_blanks(rows.where("slices is not null"))))
    dealt = rows.repartition(many, "sig", "slice").sortWithinPartitions("sig", "slice")

    def check(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        a, b = verified(rows, ranks)
        words, n = rows.column("word").combine_chunks(), rows.column("n").combine_chunks()
        for k in range(0, len(a), 50_000):
            x, y = pa.array(np.r_[a[k:k + 50_000], b[k:k + 50_000]]), pa.array(np.r_[b[k:k + 50_000], a[k:k + 50_000]])
            yield pa.RecordBatch.from_arrays([words.take(x), n.take(x), words.take(y), n.take(y)], names=["word", "n", "near", "near_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole signatures together, about CHUNK rows at a time."""
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= CHUNK:
                sig, part = batch.column(0).to_numpy(), batch.column(5).to_numpy()
                cut = int(np.flatnonzero((sig != sig[-1]) | (part != part[-1])).max(initial=-1)) + 1  # the last one may go on
                if cut or len(held) > 1 and (held[-2].column(0)[-1] != batch.column(0)[0] or held[-2].column(5)[-1] != batch.column(5)[0]):
                    rest = [held.pop().slice(cut)]
                    if cut:
                        held.append(batch.slice(0, cut))
                    yield from check(held)
                    held, size = rest, rest[0].num_rows
        if held:
            yield from check(held)
        give_back()

    return dealt.select("sig", "combo", "word", "n", "slices", "slice").mapInArrow(run, "word string, n bigint, near string, near_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): from word follow ``form`` to the last, by pointer doubling.

    A form has ten times its word's n, so chains are short and without cycles.
    """
    at = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stored(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        at = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            return at


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7, at_least: int = 2,
                      factor: int = 10, split: int = SPLIT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``."""
    words = stored(word_counts(docs, id_col, text_col, least, at_least))
    near = near_words(words, split).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("k"), F.col("near").alias("w"))).alias("best"))
    # n_near and the best near word, beside the word's own n
    all_words = stored(words.join(near, "word", "left"))
    takes = -F.col("best.k") >= factor * F.col("n")
    found = all_words.select("word", F.when(takes, F.col("best.w")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                             F.when(takes, -F.col("best.k")).alias("form_n"))
    last = roots(found.where("form is not null").select("word", "form"))
    return found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
