"""Groups of spelling variants by a variable-length gram index.

1. **Words** are counted in tasks and summed.
2. **Dictionary.** Grams of ``shortest`` characters that occur in more than one of ``share``
   words are too frequent to tell words apart, so they are extended by what follows; so are
   their extensions, up to ``longest`` characters. What must be known everywhere is only which
   grams are extended: at most ``share`` times the mean length of a word for each length, at
   any number of words.
3. **Decomposition.** At each position a word has its shortest gram that isn't extended. An
   edit changes the grams that hold the edited character (or, at the end, a gram that would go
   on there), and no others. The largest number of them over all edits is the word's bound
   ``affected``; a word at one edit keeps all the others, each at its distance from the start
   or from the end.
4. **List merging.** Two words that share all but ``affected`` grams share one of the
   ``affected + 1`` rarest of each, in an order that is the same for all words. So a word
   enters only the lists of these, by gram and distance from the start or the end. A list is
   compared with itself where lengths differ by at most one: first by letter parities, which
   an edit changes in two bits at most, then exactly. Only near pairs leave the task.
5. A word whose every gram may be affected, and lists longer than ``list_rows``, are merged by
   the words with one character left out, which is a fixed number of rows for a word and a
   bounded number of words for each such row.
6. Forms are chosen by counts and followed to the last by pointer doubling.

Defined cases: null texts have no words. A row without an id is hashed as ``:<run>``. Rows that
repeat an id count each time. Runs and words of any length are taken whole. Ties for the form
go to the first word in code-point order. An empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from topicloom.llm.common import column, lower_bytes, mixed, slices, stored
from topicloom.runtime import salted_join

_RNG = np.random.default_rng(1207)
_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 2**64))
#: Words up to this length are compared many pairs at once.
_WIDE = 64


@dataclass(frozen=True)
class SpellingVariants:
    """Words of ``min_length`` characters and ``min_count`` occurrences; a form has ``times`` the count.

    ``shortest``, ``longest`` and ``share`` shape the gram dictionary.
    """

    min_length: int = 7
    min_count: int = 2
    times: int = 10
    mangled: int = 31
    shortest: int = 2
    longest: int = 4
    share: int = 500
    list_rows: int = 16_384


def counted_words(docs: DataFrame, how: SpellingVariants) -> DataFrame:
    """``(word, n)`` of all words, some of whose runs lose a character by the hash of id and run."""
    # shorter runs can't give a word, as a character at most is taken away
    run = re.compile(f"[a-zÀ-ÿ]{{{how.min_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            total = Counter()
            for doc_id, text in zip(column(batch, "doc_id"), column(batch, "text")):
                name = "" if doc_id is None else str(doc_id)
                for word, n in Counter(run.findall(lower_bytes(text).decode("utf-8", "surrogatepass"))).items():
                    h = crc32(f"{name}:{word}".encode())
                    if h % how.mangled == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    total[word] += n
            words = [w for w in total if len(w) >= how.min_length]
            if words:
                counts = pa.array([total[w] for w in words], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), counts], ["word", "n"])

    runs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "word string, n bigint")
    return runs.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= how.min_count)


def extended_grams(words: DataFrame, how: SpellingVariants) -> dict[str, int]:
    """Grams that more than one of ``share`` words hold, with the number of these words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            total = Counter()
            for w in column(batch, "word"):
                total.update({w[p : p + q] for q in range(how.shortest, how.longest) for p in range(len(w) - q + 1)})
            if total:
                yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array(list(total.values()))], ["gram", "n"])

    grams = words.select("word").mapInArrow(count, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    least = words.count() / how.share
    return {r.gram: r.n for r in grams.where(F.col("n") > least).collect()}


def decomposed(word: str, extended: dict[str, int], how: SpellingVariants) -> tuple[list[int], int]:
    """``(ends, affected)``: the end of the gram at every position, and the bound of one edit."""
    n, ends, cover = len(word), [], [0] * (len(word) + 1)
    for start in range(n - how.shortest + 1):
        end = start + how.shortest
        while end < n and end - start < how.longest and word[start:end] in extended:
            end += 1
        ends.append(end)
        for i in range(start, end):
            cover[i] += 1
        if end == n and end - start < how.longest and word[start:end] in extended:
            # a character after the last would make this gram longer
            cover[n] += 1
    return ends, max(cover)


def gram_lists(words: DataFrame, extended: dict[str, int], how: SpellingVariants) -> DataFrame:
    """``(list, word, n)``: the words of every list that must be compared.

    ``list`` is a hash of a gram with its distance from the start or the end; it is null for
    words whose grams may all be affected and which need another way beside their lists.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            keys, rows = [], []
            for row, w in enumerate(column(batch, "word")):
                ends, affected = decomposed(w, extended, how)
                grams = sorted((extended.get(w[a:b], 0), w[a:b], a) for a, b in enumerate(ends))
                named = {f"<{a}:{g}" for _, g, a in grams[: affected + 1]}
                named |= {f">{len(w) - a}:{g}" for _, g, a in grams[: affected + 1]}
                keys += [xxhash.xxh64_intdigest(x) for x in named]
                rows += [row] * len(named)
                if affected >= len(grams):
                    keys.append(None)
                    rows.append(row)
            signed = [None if k is None else k - (1 << 64) if k >> 63 else k for k in keys]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed, pa.int64()), batch.column(0).take(rows), batch.column(1).take(rows)], ["list", "word", "n"]
            )

    return words.select("word", "n").mapInArrow(split, "list bigint, word string, n bigint")


def left_out(lists: DataFrame) -> DataFrame:
    """``(list, word, n)`` with a list for every word that one character left out gives, and for
    the word itself; the former list is part of the key."""

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            keys, rows = [], []
            for row, (old, w) in enumerate(zip(column(batch, "list"), column(batch, "word"))):
                codes = _CODE[np.frombuffer(w.encode("latin-1"), np.uint8)]
                powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(codes), _BASE, np.uint64)]))
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers[:-1], dtype=np.uint64)])
                made = np.append(sums[:-1] + (sums[-1] - sums[1:]) * _INVERSE, sums[-1])
                keys.append(np.unique(mixed(made + mixed(np.array([old or 0], np.int64).view(np.uint64)))))
                rows.append(np.full(len(keys[-1]), row))
            if keys:
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), batch.column(1).take(at), batch.column(2).take(at)],
                    ["list", "word", "n"],
                )

    return lists.select("list", "word", "n").mapInArrow(drop, "list bigint, word string, n bigint")


class WordBlock:
    """Words as byte matrices from the left and from the right, with their letter parities."""

    def __init__(self, words: list[str]):
        self.words = words
        codes = [w.encode("latin-1") for w in words]
        self.sizes = np.fromiter(map(len, codes), np.int64, len(codes))
        flat = np.frombuffer(b"".join(codes), np.uint8)
        starts = np.cumsum(self.sizes) - self.sizes
        self.parity = np.bitwise_xor.reduceat(np.uint64(1) << (flat & 63).astype(np.uint64), starts)
        wide = int(min(self.sizes.max(), _WIDE))
        ahead = np.arange(wide)
        inside = ahead < self.sizes[:, None]
        self.left = np.where(inside, flat[np.minimum(starts[:, None] + ahead, len(flat) - 1)], 0)
        self.right = np.where(inside, flat[np.maximum((starts + self.sizes)[:, None] - 1 - ahead, 0)], 0)

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether rows ``a`` and ``b`` differ by exactly one inserted, deleted or replaced character."""
        longer = np.maximum(self.sizes[a], self.sizes[b])
        equal = lambda m: np.logical_and.accumulate(m[a] == m[b], axis=1).sum(axis=1)
        # equal from the start and equal from the end, all but one character between them
        out = (equal(self.left) + equal(self.right) >= longer - 1) & (np.abs(self.sizes[a] - self.sizes[b]) <= 1)
        out &= np.any(self.left[a] != self.left[b], axis=1)
        for i in np.flatnonzero(longer > self.left.shape[1]):
            out[i] = one_edit(self.words[a[i]], self.words[b[i]])
        return out

    def pairs(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Near pairs among the rows from ``first`` to ``last``, which are sorted by length."""
        found = []
        for at in range(first, last, 128):
            stop = min(at + 128, last)
            until = first + np.searchsorted(self.sizes[first:last], self.sizes[stop - 1] + 1, "right")
            differ = np.bitwise_count(self.parity[at:stop, None] ^ self.parity[None, at:until])
            a, b = np.nonzero(differ <= 2)
            a, b = a[a < b] + at, b[a < b] + at
            for part in range(0, len(a), 65_536):
                x, y = a[part : part + 65_536], b[part : part + 65_536]
                near = self.near(x, y)
                found.append((x[near], y[near]))
        return tuple(np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1))


def one_edit(a: str, b: str) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced character."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    start = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[start + (len(a) >= len(b)) :] == b[start + (len(b) >= len(a)) :]


def near_pairs(lists: DataFrame) -> DataFrame:
    """Distinct near pairs ``(a, a_n, b, b_n)`` of words that share a list."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_lists(batches):
            keys = rows.column("list").to_numpy()
            block = WordBlock(rows.column("word").to_pylist())
            starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
            many = np.flatnonzero(np.diff(starts) > 1)
            found = [block.pairs(starts[i], starts[i + 1]) for i in many]
            if not found:
                continue
            a, b = (np.concatenate([f[i] for f in found]) for i in (0, 1))
            both = [rows.select(["word", "n"]).take(side) for side in (a, b)]
            if len(a):
                columns = [c.combine_chunks() for side in both for c in side.columns]
                yield pa.RecordBatch.from_arrays(columns, ["a", "a_n", "b", "b_n"])

    dealt = lists.withColumn("size", F.length("word")).repartition("list").sortWithinPartitions("list", "size", "word")
    found = dealt.select("list", "word", "n").mapInArrow(merge, "a string, a_n bigint, b string, b_n bigint")
    return found.select(
        F.least("a", "b").alias("a"), F.when(F.col("a") < F.col("b"), F.col("a_n")).otherwise(F.col("b_n")).alias("a_n"),
        F.greatest("a", "b").alias("b"), F.when(F.col("a") < F.col("b"), F.col("b_n")).otherwise(F.col("a_n")).alias("b_n"),
    ).distinct()


def _whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The same rows in stretches that end where a list ends."""
    kept = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if kept is None else pa.concat_tables([kept, rows]).combine_chunks()
        keys = rows.column("list").to_numpy()
        last = int(np.searchsorted(keys, keys[-1]))
        if last:
            yield rows.slice(0, last)
        kept = rows.slice(last)
    if kept is not None:
        yield kept


def word_pairs(words: DataFrame, how: SpellingVariants) -> DataFrame:
    """All near pairs ``(a, a_n, b, b_n)`` of ``(word, n)``, each once."""
    lists = stored(gram_lists(words, extended_grams(words, how), how), "gram_lists")
    sizes = lists.groupBy("list").agg(F.count(F.lit(1)).alias("members"))
    long = stored(sizes.where(F.col("list").isNotNull() & (F.col("members") > how.list_rows)).select("list"), "long_lists")
    short, rest = lists.where("list is not null"), lists.where("list is null")
    if not long.isEmpty():
        marked = salted_join(short, long.withColumn("long", F.lit(True)), ["list"])
        rest = rest.unionByName(marked.where("long").drop("long"))
        short = marked.where("long is null").drop("long")
    return near_pairs(short).unionByName(near_pairs(left_out(rest))).distinct()


def last_forms(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``(word, form)``: forms followed to the last, doubling the way each round.

    A form has many times the count of its word, so the way is short and never circular.
    """
    ways = stored(forms.select("word", F.col("form").alias("root")), "form_ways")
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stored(ways.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "form_ways")
        if after.where("next is not null").isEmpty():
            return after.select("word", "root")
        ways = after.select("word", "root")


def variants(docs: DataFrame, how: SpellingVariants = SpellingVariants()) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of ``(doc_id, text)``."""
    words = stored(counted_words(docs, how), "counted_words")
    pairs = stored(word_pairs(words, how), "near_pairs")
    ends = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    )
    best = ends.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    )
    chosen = F.coalesce(-F.col("best.minus") >= how.times * F.col("n"), F.lit(False))
    found = stored(
        words.join(best, "word", "left").select(
            "word",
            F.when(chosen, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(chosen, -F.col("best.minus")).alias("form_n"),
        ),
        "word_forms",
    )
    roots = last_forms(found.where("form is not null"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
