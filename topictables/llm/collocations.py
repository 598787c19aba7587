"""Phrase collocations: suffix pointers routed by their leading words, then sorted by multikey
three-way quicksort, in which the sizes of equal partitions are the counts."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from topictables.llm.common import alone, byte_texts, empty_caches, partitions, runs, stored, table

#: Words of the longest phrase, the least count of a candidate, and how many are returned per language.
LONGEST, LEAST, FIRST = 5, 100, 2000
#: Suffixes of a shard, on average, and those with one start from which it is routed by one word more.
SHARD, HOT = 500_000, 500_000
#: Positions whose suffixes a task looks at together, and different words that it holds.
POSITIONS, WORDS = 500_000, 150_000
#: Positions, on average, whose starts are counted in one task.
COUNTED = 4_000_000
#: Bounds of the bits in a bitmap of frequent starts, as powers of two; its largest size is 32 MB.
LEAST_BITS, MOST_BITS = 16, 28
UNDEFINED = "und"

#: A to Z become lower-case, all that ends a piece becomes a full stop, a tab a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else 46 if b in b".,;:!?" or 10 <= b <= 13 else 32 if b == 9 else b for b in range(256))
CODED = "codes binary, hash long, lang string, word string, n long"


class Hashes(dict):
    """Word -> its hash, in which language and seed are mixed; the end of a piece is 0."""

    def __init__(self, lang: str, seed: int):
        super().__init__({b".": 0})
        self.lang, self.seed = lang.encode() + b"\0", seed

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh3_64_intdigest(self.lang + word, self.seed) or 1
        return value


class Vocabularies(dict):
    """Language -> hashes of its words, with how often each was seen since the last call of `counted`."""

    def __init__(self, seed: int):
        super().__init__()
        self.seed, self.seen = seed, []

    def __missing__(self, lang: str) -> Hashes:
        value = self[lang] = Hashes(lang, self.seed)
        return value

    def codes(self, lang: str, texts: list[bytes]) -> list[bytes]:
        """The word hashes of each text, with a 0 after each piece."""
        known = self[lang]
        split = [t.translate(FOLD).replace(b".", b" . ").split() for t in texts]
        for words in split:
            words.append(b".")
        codes = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), np.uint64)
        self.seen.append(np.unique(codes, return_counts=True))
        ends = np.cumsum([0, *map(len, split)]).tolist()
        return [codes[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def words(self) -> int:
        return sum(map(len, self.values()))

    def counted(self) -> Iterator[pa.RecordBatch]:
        if self.seen:
            hashes, places = np.unique(np.concatenate([h for h, _ in self.seen]), return_inverse=True)
            counts = np.zeros(len(hashes), np.int64)
            np.add.at(counts, places, np.concatenate([n for _, n in self.seen]))
            for lang, known in self.items():
                del known[b"."]
                mine = np.fromiter(known.values(), np.uint64, len(known))
                columns = [pa.nulls(len(mine), pa.binary()), pa.array(mine.view(np.int64)), pa.array([lang] * len(mine), pa.string())]
                words = pa.array(list(known), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*columns, words, pa.array(counts[np.searchsorted(hashes, mine)])], ["codes", "hash", "lang", "word", "n"])
        self.seen = []
        self.clear()


def coded(df: DataFrame, lang_column: str, text_column: str, seed: int) -> DataFrame:
    """Rows with `codes`, the word hashes of a text, and rows (hash, lang, word, n) that count words."""
    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit(UNDEFINED))
    source = df.select(lang.alias("lang"), F.col(text_column).alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabularies(seed)
        alone(known)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                langs, texts = part.column(0).to_pylist(), byte_texts(part.column(1))
                for lang in dict.fromkeys(langs):
                    codes = pa.array(known.codes(lang, [t for x, t in zip(langs, texts, strict=True) if x == lang]), pa.binary())
                    rest = [pa.nulls(len(codes), t) for t in (pa.int64(), pa.string(), pa.string(), pa.int64())]
                    yield pa.RecordBatch.from_arrays([codes, *rest], ["codes", "hash", "lang", "word", "n"])
                if known.words() > WORDS:
                    yield from known.counted()
        yield from known.counted()
        empty_caches()

    return source.mapInArrow(read, CODED)


def mixed(columns: list[np.ndarray]) -> np.ndarray:
    """A hash of each row of these columns."""
    total = np.full(len(columns[0]), len(columns), np.uint64)
    for c in columns:
        total = (total ^ (total >> np.uint64(31)) ^ c) * np.uint64(0x9E3779B97F4A7C15)
    return total ^ (total >> np.uint64(32))


class Bitmap:
    """Fixed number of bits; a hash is in it if the bit of its uppermost digits is set."""

    def __init__(self, bits: int):
        self.bits = bits
        self.set = np.zeros(1 << bits >> 3, np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> np.uint64(64 - self.bits)).view(np.int64)
        return (self.set[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _of_words(frequent: DataFrame, bits: int) -> Bitmap:
    """The bits of column `hash`, made in the executors and sent in blocks of 4 KB."""
    at = F.shiftrightunsigned("hash", 64 - bits) + 1  # Spark's bitmaps begin with 1
    parts = frequent.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    bitmap = Bitmap(bits)
    for r in parts.collect():
        start = (r["part"] - 1) * 4096
        bitmap.set[start : start + 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return bitmap


def planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32, the lowest byte of each first, then the next of each: the uppermost bytes are
    mostly zero, and side by side they take little room once compressed."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(4, -1).T).view("<u4").ravel()


class Starts:
    """What is known of frequent words and pairs, and of starts of 2, 3, ... words that are hot."""

    def __init__(self, words: Bitmap):
        self.words, self.pairs, self.hot = words, None, []

    def depths(self, codes: np.ndarray) -> np.ndarray:
        """Of each position, how many words from it on, LONGEST at most, hold frequent words and pairs only."""
        able = self.words.has(codes) & (codes != 0)
        linked = np.zeros(len(codes) + LONGEST, bool)
        linked[: len(codes) - 1] = able[:-1] & able[1:]
        if self.pairs is not None:
            at = np.flatnonzero(linked)
            linked[at] = self.pairs.has(mixed([codes[at], codes[at + 1]]))
        depth, going = able.astype(np.int64), np.ones(len(codes), bool)
        for k in range(LONGEST - 1):
            going &= linked[k : k + len(codes)]
            depth += going
        return depth

    def routes(self, codes: np.ndarray, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """By how many leading words the suffixes at these positions are routed: 2, or one more than
        the words of their longest hot start, which may be one more than they have."""
        route = np.full(len(at), 2)
        for words, hot in enumerate(self.hot, 2):
            able = np.flatnonzero((route == words) & (depth[at] >= words))
            able = able[hot.has(mixed([codes[at[able] + j] for j in range(words)]))]
            route[able] = words + 1
        return route


def _gathered(batches: Iterator[pa.RecordBatch], positions: int) -> Iterator[np.ndarray]:
    """The codes of about so many positions at a time, whole texts."""
    held, size = [], 0
    for batch in batches:
        column = batch.column(0)
        for at in range(0, len(column), 500):
            part = column.slice(at, 500)
            codes = np.frombuffer(b"".join(part.to_pylist()), np.uint64)
            held.append(codes)
            size += len(codes)
            if size >= positions:
                yield np.concatenate(held)
                held, size = [], 0
    if size:
        yield np.concatenate(held)


def _start_counts(codes: DataFrame, starts: Starts, words: int, bits: int, ranges_log: int, least: int, hot: int, positions: int) -> tuple[Bitmap, Bitmap, int]:
    """Which buckets of starts of so many words, where all shorter ones are hot, hold `least` positions or
    more, and which more than `hot`; and the sum of the positions in the former.

    A task counts the buckets of a slice and sends them, by range of buckets, as differences and counts.
    Buckets come from a hash, so ranges are even, and a slice has a bucket once.
    """
    shared = codes.sparkSession.sparkContext.broadcast(starts)
    within = bits - ranges_log

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _gathered(batches, positions):
            depth = shared.value.depths(part)
            at = np.flatnonzero(depth >= words)
            at = at[shared.value.routes(part, at, depth) >= words]
            found, n = np.unique(mixed([part[at + j] for j in range(words)]) >> np.uint64(64 - bits), return_counts=True)
            found = found.view(np.int64)
            cuts = np.searchsorted(found, np.arange((1 << ranges_log) + 1) << within)
            some = np.flatnonzero(np.diff(cuts))
            buckets = [planes(np.diff(found[cuts[r] : cuts[r + 1]], prepend=r << within)) for r in some.tolist()]
            counts = [planes(n[cuts[r] : cuts[r + 1]]) for r in some.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(buckets, pa.binary()), pa.array(counts, pa.binary())], ["range", "buckets", "counts"])

    def add(key: tuple, group: pa.Table) -> pa.Table:
        total = np.zeros(1 << within, np.int64)
        for buckets, counts in zip(group.column("buckets").to_pylist(), group.column("counts").to_pylist(), strict=True):
            total[np.cumsum(from_planes(buckets), dtype=np.int64)] += from_planes(counts)
        often = total >= least
        sets = [np.packbits(x, bitorder="little").tobytes() for x in (often, total > hot)]
        return pa.table({"range": pa.array([key[0].as_py()], pa.int32()), "often": [sets[0]], "hot": [sets[1]], "n": [int(total[often].sum())]})

    often, crowded, n = Bitmap(bits), Bitmap(bits), 0
    size = 1 << within >> 3
    for r in codes.mapInArrow(count, "range int, buckets binary, counts binary").groupBy("range").applyInArrow(add, "range int, often binary, hot binary, n long").collect():
        part = slice(r["range"] * size, (r["range"] + 1) * size)
        often.set[part] = np.frombuffer(bytes(r["often"]), np.uint8)
        crowded.set[part] = np.frombuffer(bytes(r["hot"]), np.uint8)
        n += r["n"]
    return often, crowded, n


def collapsed(columns: list[np.ndarray], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each different row of these columns, where it stands first, and the sum of its weights."""
    if not len(weights):
        return np.zeros(0, np.int64), weights
    key = mixed(columns)
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = key[1:] == key[:-1]
    pairs = np.flatnonzero(same)
    if any((c[order[pairs + 1]] != c[order[pairs]]).any() for c in columns):  # two rows with one hash
        order = np.lexsort(columns)
        same = np.all([c[order[1:]] == c[order[:-1]] for c in columns], axis=0)
    first = np.flatnonzero(np.r_[True, ~same])
    return order[first], np.add.reduceat(weights[order], first)


def partitioned(rows: np.ndarray, weights: np.ndarray, least: int, shortest: int) -> Iterator[tuple[int, int, int]]:
    """(words, row, count) of every start of `shortest` to LONGEST words, 0 being no word, that weighs
    `least` or more; `row` is one that has it.

    Multikey three-way quicksort of pointers to rows: a partition is split by the word at its depth
    into less, equal and greater; only the equal part goes on to the next word, and its weight is the
    count of the words so far. A part below `least` can hold no frequent start and is left unsorted.
    """
    todo = [(np.arange(len(rows)), 0)]
    while todo:
        at, depth = todo.pop()
        words = rows[at, depth]
        pivot = np.sort(words[:: len(words) // 9 + 1])
        pivot = pivot[len(pivot) // 2]
        less, greater = words < pivot, words > pivot
        for side in (less, greater):
            part = at[side]
            if len(part) and weights[part].sum() >= least:
                todo.append((part, depth))
        equal = at[~(less | greater)]
        n = int(weights[equal].sum())
        if pivot and n >= least:
            if depth + 1 >= shortest:
                yield depth + 1, int(equal[0]), n
            if depth + 1 < LONGEST:
                todo.append((equal, depth + 1))


def packed(words: np.ndarray, weights: np.ndarray) -> bytes:
    """Suffixes (rows of LONGEST hashes) and weights, with each hash once."""
    names, ids = np.unique(words.T.ravel(), return_inverse=True)
    head = np.array([len(weights), len(names)], "<u8").tobytes()
    return head + names.astype("<u8").tobytes() + planes(ids) + planes(weights)


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, names = np.frombuffer(blob, "<u8", 2).astype(int).tolist()
    at = 16 + 8 * names
    ids = from_planes(blob[at : at + 4 * LONGEST * n])
    return np.frombuffer(blob, "<u8", names, 16)[ids].reshape(LONGEST, n).T, from_planes(blob[at + 4 * LONGEST * n :]).astype(np.int64)


def phrase_counts(codes: DataFrame, starts: Starts, least: int, shards: int, positions: int) -> DataFrame:
    """(phrase, a) of all phrases of 2 to LONGEST words, as arrays of hashes, that occur `least` times or
    more. Equal suffixes of a slice become one record before they are routed."""
    shared = codes.sparkSession.sparkContext.broadcast(starts)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _gathered(batches, positions):
            depth = shared.value.depths(part)
            at = np.flatnonzero(depth >= 2)
            by = shared.value.routes(part, at, depth)
            padded = np.r_[part, np.zeros(LONGEST, np.uint64)]
            columns = [np.where(depth[at] > j, padded[at + j], np.uint64(0)) for j in range(LONGEST)]
            first, weights = collapsed(columns, np.ones(len(at), np.int64))
            words, by = np.stack([c[first] for c in columns], axis=1), by[first]
            del columns, padded, depth
            shard = np.zeros(len(words), np.int64)
            for n in range(2, LONGEST + 1):
                here = np.flatnonzero(by == n)
                shard[here] = (mixed([words[here, j] for j in range(n)]) % np.uint64(shards)).astype(np.int64)
            name = shard * (LONGEST + 1) + by
            order = np.argsort(name, kind="stable")
            starts_at, sizes = runs(name[order])
            for k in range(0, len(starts_at), 1000):
                some = [order[a : a + n] for a, n in zip(starts_at[k : k + 1000].tolist(), sizes[k : k + 1000].tolist(), strict=True)]
                ones = [x[0] for x in some]
                blobs = pa.array([packed(words[x], weights[x]) for x in some], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(shard[ones]), pa.array(by[ones], pa.int32()), blobs], ["shard", "route", "suffixes"])

    def sort(key: tuple, group: pa.Table) -> pa.Table:
        route, phrases, counts = key[1].as_py(), [], []
        parts = [unpacked(blob) for blob in group.column("suffixes").to_pylist()]
        words, weights = np.concatenate([w for w, _ in parts]), np.concatenate([n for _, n in parts])
        del parts
        first, weights = collapsed(list(words.T), weights)
        words = words[first]
        for length, row, count in partitioned(words, weights, least, route):
            phrases.append(words[row, :length].view(np.int64))
            counts.append(count)
        for length in range(2, route):  # a hot start lies in several shards: its parts are added up later
            first, sums = collapsed(list(words[:, :length].T), weights)
            phrases.extend(words[first, :length].view(np.int64))
            counts += sums.tolist()
        return pa.table({"phrase": pa.array(phrases, pa.list_(pa.int64())), "a": pa.array(counts, pa.int64())})

    routed = codes.mapInArrow(route, "shard long, route int, suffixes binary")
    found = routed.groupBy("shard", "route").applyInArrow(sort, "phrase array<long>, a long")
    return found.groupBy("phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= least)


def _frequent(rows: DataFrame, least: int) -> DataFrame:
    """(hash, lang, word, f, one) of every hash that `least` words or more have; one is false if they are
    not all the same. Hashes are counted; only what is frequent is then looked up as text."""
    counted = rows.where("hash IS NOT NULL")
    often = stored(counted.groupBy("hash").agg(F.sum("n").alias("f")).where(F.col("f") >= least))
    name = F.struct("lang", "word")
    found = counted.select("hash", "lang", "word").join(often, "hash").groupBy("hash").agg(F.min(name).alias("w"), F.max(name).alias("v"), F.min("f").alias("f"))
    return found.select("hash", "w.lang", "w.word", "f", (F.col("w") == F.col("v")).alias("one"))


def collocations(df: DataFrame, lang_column: str = "lang", text_column: str = "text", least: int = LEAST, first: int = FIRST, shard: int = SHARD, hot: int = HOT, positions: int = POSITIONS, bits: int | None = None) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): per language the `first` phrases of 2 to 5 words by score.

    Words are counted, then the pairs of frequent words by the bucket of their hash; the bitmaps of
    frequent buckets, of bounded size, cut suffixes short that can hold no frequent phrase. What is left
    is routed by its leading two words to shards, of which each is sorted as in `partitioned`; a start
    that more than `hot` positions share is routed by a word more. Words stand as hashes by which
    no frequent word equals any other word of the table: that is checked, and the hash is seeded anew
    if one does.

    A null lang is `und`; null and empty texts hold nothing; repeated rows count as often as they
    occur; other columns are ignored; without candidates, or rows, the result is empty.
    """
    spark = df.sparkSession
    for seed in range(100):
        rows = stored(coded(df, lang_column, text_column, seed))
        frequent = stored(_frequent(rows, least))
        if not frequent.where("NOT one").head(1):
            break
    totals = stored(rows.where("hash IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n")))
    tokens = int(totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    bits = bits or min(MOST_BITS, max(LEAST_BITS, (tokens // 8).bit_length()))
    ranges_log = min(bits - 3, max(partitions(spark), tokens // COUNTED).bit_length())
    codes = rows.where("codes IS NOT NULL").select("codes")
    starts = Starts(_of_words(frequent, bits))
    starts.pairs, crowded, suffixes = _start_counts(codes, starts, 2, bits, ranges_log, least, hot, positions)
    for length in range(3, LONGEST + 1):
        if not crowded.set.any():
            break
        starts.hot.append(crowded)
        if length < LONGEST:
            _, crowded, _ = _start_counts(codes, starts, length, bits, ranges_log, least, hot, positions)
    shards = max(partitions(spark), suffixes // shard + 1)
    counts = stored(phrase_counts(codes, starts, least, shards, positions))

    longer = counts.where(F.size("phrase") > 2)
    within = longer.select(F.explode(F.array(F.expr("slice(phrase, 1, size(phrase) - 1)"), F.expr("slice(phrase, 2, size(phrase) - 1)"))).alias("phrase"), "a")
    left = counts.join(within.distinct(), ["phrase", "a"], "left_anti")
    parts = counts.unionByName(frequent.select(F.array("hash").alias("phrase"), F.col("f").alias("a")))
    cuts = left.select("phrase", "a", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k"))
    cuts = cuts.select("phrase", "a", "k", F.expr("slice(phrase, 1, k)").alias("one"), F.expr("slice(phrase, k + 1, size(phrase) - k)").alias("two"))
    cuts = cuts.join(parts.select(F.col("phrase").alias("one"), F.col("a").alias("l")), "one").join(parts.select(F.col("phrase").alias("two"), F.col("a").alias("r")), "two")
    spelled = left.select("phrase", F.posexplode("phrase").alias("at", "hash")).join(frequent.select("hash", "lang", "word"), "hash")
    spelled = spelled.groupBy("phrase").agg(F.min("lang").alias("lang"), F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]).alias("words"))
    named = spelled.join(totals, "lang").select("phrase", "lang", "n", F.concat_ws(" ", "words").alias("text"))
    score = F.expr("(1000 * CAST(a AS DECIMAL(15,0)) * CAST(n AS DECIMAL(19,0))) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")
    scored = cuts.join(named, "phrase").withColumn("score", score)
    lowest = scored.groupBy("phrase").agg(F.min(F.struct("score", "k", "lang", "text", "a", "l", "r", "n")).alias("x")).select("x.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "text")
    best = lowest.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= first)
    return best.select("lang", "rank", F.col("text").alias("phrase"), "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of each language; nulls, repeats and empty tables as in `collocations`."""
    return collocations(table(spark, sf_dir, "documents"))


def oracle(least: int = LEAST, first: int = FIRST) -> str:
    """The same in SQL, every phrase counted as text."""
    return f"""
    WITH p AS (
        SELECT coalesce(lang, '{UNDEFINED}') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM p),
    g AS (SELECT lang, words, k, unnest(generate_series(1, len(words) - k + 1)) AS i FROM w, (SELECT unnest(generate_series(1, {LONGEST})) AS k) WHERE len(words) >= k),
    f AS (SELECT lang, k, array_to_string(words[i : i + k - 1], ' ') AS phrase, count(*) AS a FROM g GROUP BY ALL),
    n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
    c AS (SELECT * FROM f WHERE k > 1 AND a >= {least}),
    kept AS (SELECT * FROM c WHERE NOT EXISTS (
        SELECT 1 FROM c AS o WHERE o.lang = c.lang AND o.k > c.k AND 100 * o.a >= 100 * c.a AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))),
    cut AS (SELECT lang, phrase, a, string_split(phrase, ' ') AS words, unnest(generate_series(1, k - 1)) AS place FROM kept),
    s AS (
        SELECT cut.lang, cut.phrase, cut.a, place, x.a AS l, y.a AS r, n, ((1000::HUGEINT * cut.a * n) // (x.a::HUGEINT * y.a))::BIGINT AS score
        FROM cut JOIN n USING (lang) JOIN f AS x ON x.lang = cut.lang AND x.phrase = array_to_string(words[: place], ' ')
        JOIN f AS y ON y.lang = cut.lang AND y.phrase = array_to_string(words[place + 1 :], ' ')),
    b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, place) = 1),
    o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
    SELECT lang, rank, phrase, a, l, r, n, score FROM o WHERE rank <= {first}"""


ORACLE = oracle()
