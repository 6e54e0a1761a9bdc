"""Phrases whose words occur together more often than apart, mined with stripes.

A stripe belongs to a prefix (a run of words) and counts the words that follow
it, with one counter for all followers that cannot start anything frequent and
for the end of a piece. Tasks fill stripes from their texts, stripes of one
prefix are merged element by element, and one merged stripe gives the prefix's
extensions (its counters), its total (their sum) and its largest extension.

A phrase can be frequent only if the phrases one word shorter at either end are,
so lengths are worked through in turn. What is known to be frequent goes to the
tasks as a table of bits, one for each hash: a phrase whose bit is off is not
frequent, one whose bit is on by chance is counted in vain. The table has at most
2^26 bits, whatever the number of phrases, so only the work and never the result
depends on how full it is. Stripes of very frequent prefixes (at most 1,000, as
each has a thousandth of all words) are split by their followers' hashes, so that
no task merges a whole one.

Words and phrases are 64-bit hashes until the end. Everything is per language.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .hashing import U, mix, word_spans
from .session import columns, written

#: Followers a task gathers before it sends stripes, distinct words before it sends their counts, and rows it sends at a time.
PAIRS, WORDS, ROWS = 1 << 19, 100_000, 1 << 14
#: Parts of the stripe of a prefix that holds at least a share of 1 / HOT of all words.
SLOTS, HOT = 64, 1000
MOST_BITS = 26

_BREAK = np.isin(np.arange(256), [ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D])
_GAP = _BREAK | np.isin(np.arange(256), [0x20, 0x09])


def language_seed(lang: str) -> np.uint64:
    return U(int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))


def extend(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase and one more word; 0, which stands for no word, stays 0."""
    out = mix(prefix * U(0x9FB21C651E98DF25) + word) | U(1)
    out[(prefix == 0) | (word == 0)] = 0
    return out


def phrases(seq: np.ndarray, length: int) -> np.ndarray:
    """Hash of the phrase of ``length`` words at each place; 0 where a piece ends before that."""
    out = seq
    for k in range(1, length):
        out = extend(out[:-1], seq[k:])
    return out


def word_sequence(text: bytes, seed: np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, places, starts, ends): word hashes with a 0 behind each piece, and each word's place in it and in the text."""
    data = np.frombuffer(text, np.uint8)
    parts = list(word_spans(data, _GAP))
    if not parts:
        return np.zeros(1, U), *[np.zeros(0, np.int64)] * 3
    hashes, starts, ends = (np.concatenate(x) for x in zip(*parts))
    pieces = np.searchsorted(np.flatnonzero(_BREAK[data]), starts)
    places = np.arange(len(starts)) + np.concatenate([[0], np.cumsum(pieces[1:] != pieces[:-1])])[: len(starts)]
    seq = np.zeros(places[-1] + 2 if len(places) else 1, U)
    seq[places] = mix(hashes ^ seed) | U(1)
    return seq, places, starts, ends


def sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of ROWS rows, so that neither side of the pipe between Python and Spark holds a whole large batch twice."""
    for at in range(0, max(batch.num_rows, 1), ROWS):
        yield batch.slice(at, ROWS)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        yield lang, text.as_buffer().to_pybytes()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, gram, n): counts of words; the row of gram 0 counts all words of the language."""
    counts: dict[int, list] = {}
    totals: dict[str, int] = {}

    def flush():
        grams = np.zeros(len(counts) + len(totals), U)
        grams[: len(counts)] = np.fromiter(counts, U, len(counts))
        out = pa.RecordBatch.from_arrays(
            [
                pa.array(chain((v[1] for v in counts.values()), totals), pa.string()), pa.array(chain((v[2] for v in counts.values()), repeat("", len(totals))), pa.string()),
                pa.array(grams.view(np.int64)), pa.array(chain((v[0] for v in counts.values()), totals.values()), pa.int64()),
            ],
            ["lang", "word", "gram", "n"],
        )
        counts.clear()
        totals.clear()
        return sliced(out)

    for batch in batches:
        for lang, text in _texts(batch):
            seq, places, starts, ends = word_sequence(text, language_seed(lang))
            totals[lang] = totals.get(lang, 0) + len(places)
            grams, first, times = np.unique(seq[places], return_index=True, return_counts=True)
            for gram, i, n in zip(grams.tolist(), first.tolist(), times.tolist()):
                if gram in counts:
                    counts[gram][0] += n
                else:
                    counts[gram] = [n, lang, text[starts[i] : ends[i]].translate(_LOWER).decode("utf-8", "replace")]
                if len(counts) > WORDS:
                    yield from flush()
    yield from flush()


_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))


class Bits:
    """A table of bits that knows which hashes are frequent, with few errors to one side."""

    def __init__(self, table: bytes):
        self.table = np.frombuffer(table, U)
        self.mask = U(len(self.table) * 64 - 1)

    def has(self, grams: np.ndarray) -> np.ndarray:
        at = (grams >> U(8)) & self.mask
        return ((self.table[(at >> U(6)).astype(np.int64)] >> (at & U(63))) & U(1)).astype(bool) & (grams != 0)


def bit_table(grams: DataFrame) -> bytes:
    """Bits of all hashes in column ``gram``: about 16 for each, 2^16 at least and 2^26 (8 MB) at most."""
    size = min(MOST_BITS, max(16, (16 * grams.count()).bit_length()))
    at = F.shiftright("gram", 8).bitwiseAND((1 << size) - 1)
    rows = grams.select(at.alias("p")).selectExpr("p >> 6 AS at", "shiftleft(1L, cast(p & 63 AS int)) AS bit")
    table = np.zeros(1 << (size - 6), np.int64)
    for batch in rows.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow().to_batches():
        table[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return table.tobytes()


def _stripe_batch(prefix: np.ndarray, follower: np.ndarray, hot: np.ndarray) -> pa.RecordBatch:
    """Stripes of (prefix, follower) pairs, equal pairs counted."""
    _, first, times = np.unique(mix(prefix + U(0x1B873593)) ^ follower, return_index=True, return_counts=True)
    prefix, follower = prefix[first], follower[first]
    slot = np.where(np.isin(prefix, hot), (follower >> U(20)) % U(SLOTS), U(0)).astype(np.int32)
    order = np.lexsort((slot, prefix))
    prefix, follower, slot, times = prefix[order], follower[order], slot[order], times[order]
    return _rows(prefix, slot, follower, times)


def _heads(prefix: np.ndarray, slot: np.ndarray) -> np.ndarray:
    if not len(prefix):
        return np.zeros(0, np.int64)
    return np.concatenate([[0], np.flatnonzero((prefix[1:] != prefix[:-1]) | (slot[1:] != slot[:-1])) + 1])


def _rows(prefix, slot, follower, times) -> pa.RecordBatch:
    heads = _heads(prefix, slot)
    offsets = pa.array(np.append(heads, len(prefix)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(prefix[heads].view(np.int64)), pa.array(slot[heads]),
            pa.ListArray.from_arrays(offsets, pa.array(follower.view(np.int64))), pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int64))),
        ],
        ["prefix", "slot", "next", "n"],
    )


STRIPE = "prefix long, slot int, next array<long>, n array<long>"


def _fill_stripes(sequences, length: int, frequent, hot: list[int]):
    """Stripes of the frequent prefixes of ``length`` words of all sequences in a task's batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, heavy = Bits(frequent.value), np.array(hot, np.int64).view(U)
        prefixes, followers, held = [], [], 0

        def stripes() -> pa.RecordBatch:
            prefix, follower = np.concatenate(prefixes), np.concatenate(followers)
            prefixes.clear()
            followers.clear()
            return _stripe_batch(prefix, follower, heavy)

        for batch in batches:
            for seq in sequences(batch):
                grams = phrases(seq, length) if len(seq) > length else seq[:0]
                alive = bits.has(grams)
                at = np.flatnonzero(alive)
                if not len(at):
                    continue
                # A follower counts if the phrase that it ends may be frequent; all others share the counter 0.
                after = np.where(np.append(alive, False)[at + 1], seq[np.minimum(at + length, len(seq) - 1)], U(0))
                prefixes.append(grams[at])
                followers.append(after)
                held += len(at)
                if held >= PAIRS:
                    yield from sliced(stripes())
                    held = 0
        if held:
            yield from sliced(stripes())

    return run


def _text_sequences(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for lang, text in _texts(batch):
        yield word_sequence(text, language_seed(lang))[0]


def _stored_sequences(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for value in batch.column(0):
        yield np.frombuffer(value.as_buffer(), U)


def _live_runs(pairs):
    """Runs of words whose neighbours all may be frequent pairs: all that longer phrases can be made of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = Bits(pairs.value)
        for batch in batches:
            parts = []
            for seq in _text_sequences(batch):
                joined = np.append(bits.has(phrases(seq, 2)) if len(seq) > 1 else np.zeros(0, bool), False)
                inside = joined | np.concatenate([[False], joined[:-1]])
                # A 0 stands behind each run: at the first place that is not joined to the next one.
                keep, end = np.flatnonzero(inside), np.flatnonzero(inside & ~joined)
                parts.append(np.insert(seq[keep], np.searchsorted(keep, end) + 1, U(0)))
            whole = np.concatenate(parts) if parts else np.zeros(0, U)
            if len(whole):
                yield pa.RecordBatch.from_arrays([pa.array([whole.tobytes()], pa.binary())], ["words"])

    return run


def _merge_stripes(least: int):
    """One stripe of several of one (prefix, slot), which come next to each other; counters below ``least`` go once all are added."""

    def merged(prefix, slot, follower, times):
        order = np.lexsort((follower, slot, prefix))
        prefix, slot, follower, times = prefix[order], slot[order], follower[order], times[order]
        new = np.ones(len(prefix), bool)
        new[1:] = (prefix[1:] != prefix[:-1]) | (slot[1:] != slot[:-1]) | (follower[1:] != follower[:-1])
        at = np.flatnonzero(new)
        return prefix[at], slot[at], follower[at], np.add.reduceat(times, at) if len(at) else times

    def finished(prefix, slot, follower, times) -> pa.RecordBatch:
        heads = _heads(prefix, slot)
        total = np.add.reduceat(times, heads) if len(heads) else times
        best = np.maximum.reduceat(np.where(follower != 0, times, 0), heads) if len(heads) else times
        keep = (follower != 0) & (times >= least)
        offsets = pa.array(np.append(0, np.cumsum(keep))[np.append(heads, len(keep))].astype(np.int32))
        lists = [follower[keep].view(np.int64), times[keep], extend(prefix[keep], follower[keep]).view(np.int64)]
        return pa.RecordBatch.from_arrays(
            [pa.array(prefix[heads].view(np.int64)), *[pa.ListArray.from_arrays(offsets, pa.array(v)) for v in lists], pa.array(total), pa.array(best)],
            ["prefix", "next", "n", "gram", "total", "best"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, U), np.zeros(0, np.int32), np.zeros(0, U), np.zeros(0, np.int64)]
        for batch in batches:
            prefix, slot = batch.column(0).to_numpy().view(U), batch.column(1).to_numpy()
            if not len(prefix):
                continue
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            flat = [batch.column(2).flatten().to_numpy().view(U), batch.column(3).flatten().to_numpy()]
            now = [np.repeat(prefix, sizes), np.repeat(slot, sizes), *flat]
            now = merged(*[np.concatenate([h, v]) for h, v in zip(held, now)])
            open_ = (now[0] == prefix[-1]) & (now[1] == slot[-1])
            held = [v[open_] for v in now]
            yield finished(*[v[~open_] for v in now])
        yield finished(*held)

    return run


def _stripes(parts: DataFrame, least: int, name: str) -> DataFrame:
    """(prefix, next, n, gram, total, best): all stripes of a prefix and slot added up."""
    dealt = parts.repartition("prefix", "slot").sortWithinPartitions("prefix", "slot")
    return written(
        dealt.mapInArrow(_merge_stripes(least), "prefix long, next array<long>, n array<long>, gram array<long>, total long, best long"), name
    )


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of a phrase's first and last parts for every cut."""
    for batch in batches:
        lefts, rights = [], []
        for words in batch.column(1).to_pylist():
            seq = np.array(words, np.int64).view(U)
            lefts.append([int(phrases(seq[:k], k).view(np.int64)[0]) for k in range(1, len(seq))])
            rights.append([int(phrases(seq[k:], len(seq) - k).view(np.int64)[0]) for k in range(1, len(seq))])
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lefts, kind), pa.array(rights, kind)], ["gram", "lefts", "rights"])


def frequent_phrases(df: DataFrame, least: int = 100, longest: int = 5, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(languages, phrases, stripes) of a table of texts.

    ``languages`` has (lang, n): all word occurrences. ``phrases`` has (gram,
    lang, phrase, words, a, length) of every phrase of 1 to ``longest`` words
    with a >= ``least`` occurrences; ``gram`` is its hash, ``words`` those of its
    words. ``stripes`` has (gram, total, best) of all of them that are shorter
    than ``longest``: its occurrences as the sum of its stripe, and the most
    frequent phrase that has one more word behind.
    """
    spark = df.sparkSession
    source = columns(df, lang, text).toDF("lang", "text").select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    counted = source.mapInArrow(_count_words, "lang string, word string, gram long, n long")
    counted = counted.groupBy("lang", "word", "gram").agg(F.sum("n").alias("n")).filter((F.col("gram") == 0) | (F.col("n") >= least))
    counted = written(counted, "words")
    languages = counted.filter("gram = 0").select("lang", "n")
    words = counted.filter("gram != 0")
    level = words.select("gram", "lang", F.col("word").alias("phrase"), F.array("gram").alias("words"), F.col("n").alias("a"), F.lit(1).alias("length"))
    all_words = languages.agg(F.sum("n")).first()[0] or 0
    found, stripes, live = [level], [], None
    for length in range(1, longest):
        bits = spark.sparkContext.broadcast(bit_table(level))
        hot = [r["gram"] for r in level.filter(F.col("a") * HOT >= all_words).select("gram").collect()]  # at most HOT rows
        if length == 2:
            live = written(source.mapInArrow(_live_runs(bits), "words binary"), "runs")
        if length == 1:
            parts = source.mapInArrow(_fill_stripes(_text_sequences, length, bits, hot), STRIPE)
        else:
            parts = live.mapInArrow(_fill_stripes(_stored_sequences, length, bits, hot), STRIPE)
        merged = _stripes(parts, least, f"stripes{length}")
        stripes.append(merged.select(F.col("prefix").alias("gram"), "total", "best"))
        each = merged.select("prefix", F.explode(F.arrays_zip("next", "n", "gram")).alias("e")).select("prefix", "e.*")
        tail = words.select(F.col("gram").alias("next"), "word")
        before = level.select(F.col("gram").alias("prefix"), "lang", "phrase", "words")
        level = written(
            each.join(before, "prefix").join(tail, "next").select(
                "gram", "lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), F.array_append("words", F.col("next")).alias("words"),
                F.col("n").alias("a"), F.lit(length + 1).alias("length"),
            ),
            f"phrases{length + 1}",
        )
        found.append(level)
    whole, totals = found[0], stripes[0] if stripes else None
    for more in found[1:]:
        whole = whole.unionByName(more)
    for more in stripes[1:]:
        totals = totals.unionByName(more)
    totals = totals.groupBy("gram").agg(F.sum("total").alias("total"), F.max("best").alias("best"))
    return languages, whole, totals


def collocations(
    df: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, within: int = 100, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    Texts are lower-cased (A-Z) and split into pieces at ``.,;:!?`` and the line
    ends 0x0A-0x0D, pieces into words at spaces and tabs. Candidates are phrases
    of 2 to ``longest`` words with ``a`` >= ``least`` occurrences inside pieces,
    overlapping ones counted. A cut after the first k words gives l and r, the
    occurrences of the two parts, and floor(1000 a n / (l r)), n being the
    language's words; the cut of the lowest value counts, the smallest k among
    equals. A candidate goes if a longer one that contains it has at least
    ``within`` hundredths of its occurrences. Order: score and a descending, then
    the phrase's bytes.

    Null texts are empty, a null language is ``und``, repeated rows count each
    time. An empty table, or one without frequent phrases, gives no rows.
    """
    languages, whole, totals = frequent_phrases(df, least, longest, text, lang)
    totals = written(totals, "totals")
    candidates = written(whole.filter("length > 1"), "candidates")
    cuts = written(candidates.select("gram", "words").mapInArrow(_cuts, "gram long, lefts array<long>, rights array<long>"), "cuts")
    each = cuts.select("gram", F.posexplode(F.arrays_zip("lefts", "rights")).alias("k", "e"))
    left, right = totals.select(F.col("gram").alias("lefts"), F.col("total").alias("l")), totals.select(F.col("gram").alias("rights"), F.col("total").alias("r"))
    exact = "decimal(38,0)"
    parts = (
        each.select("gram", "k", "e.lefts", "e.rights").join(left, "lefts").join(right, "rights")
        .join(candidates.select("gram", "a", "lang"), "gram").join(languages, "lang")
        .withColumn("score", F.expr(f"cast(cast(1000 as {exact}) * cast(a as {exact}) * n div (cast(l as {exact}) * r) as long)"))
    )
    best = parts.groupBy("gram").agg(F.min(F.struct("score", "k", "l", "r", "n")).alias("cut"))
    # The most frequent phrase with one more word in front; longer ones hold one of these two.
    front = (
        cuts.join(candidates.filter("length > 2").select("gram", "a"), "gram")
        .groupBy(F.col("rights")[0].alias("gram")).agg(F.max("a").alias("front"))
    )
    behind = totals.select("gram", F.col("best").alias("behind"))
    larger = F.greatest(F.coalesce("front", F.lit(0)), F.when(F.coalesce("behind", F.lit(0)) >= least, F.col("behind")).otherwise(0))
    kept = (
        candidates.select("gram", "lang", "phrase", "a").join(best, "gram").join(front, "gram", "left").join(behind, "gram", "left")
        .filter((larger == 0) | (100 * larger < within * F.col("a")))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")
