"""Substring dedup: suffix automata of reference shards give matching statistics of the documents.

The reference of a deduplicated corpus is the corpus itself, so a broadcast of its automata would grow
without bound. Shards are therefore routed: windows of equal words share their smallest word n-gram,
the anchor, so all documents that can match a shard meet it in one task, and anchors that occur once
in the corpus leave no text to look at. Within a shard the automaton is built over the segments around
one anchor, in the order of the documents, and each segment is streamed through it before it joins.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topictables.llm.common import byte_texts, each_batch, partitions, runs, shared_folder, stored, table, word_hashes

#: Words of a window and of an anchor.
WINDOW, ANCHOR = 20, 6
#: Of an anchor that occurs more often, every window goes to the shard of its own words.
HOT = 2000
#: Documents that a task looks at together.
SLICE = 1000

KEY_BYTES = 12
ENTRY = np.dtype([("anchor", "<u8"), ("key", f"V{KEY_BYTES}"), ("at", "<u4"), ("rows", "<u4")])
PLACE = np.dtype([("key", f"V{KEY_BYTES}"), ("at", "<u4")])


def key_of(words: list[bytes]) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(b" ".join(words))[:KEY_BYTES]


def anchored(values: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of documents one after another, given as word hashes and their ends: the runs of windows with the
    same anchor, as (first window, windows, place of the anchor, its hash). The anchor of a window is
    its n-gram with the smallest hash, the first of several."""
    none = np.zeros(0, np.int64)
    n = len(values) - WINDOW + 1
    if n < 1:
        return none, none, none, np.zeros(0, np.uint64)
    grams = np.zeros(len(values) - ANCHOR + 1, np.uint64)
    for j in range(ANCHOR):
        grams = (grams + values[j : j + len(grams)]) * np.uint64(0x9E3779B97F4A7C15)
        grams ^= grams >> np.uint64(31)
    width = WINDOW - ANCHOR + 1
    least, span = grams, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:n], least[width - span : width - span + n])
    place = np.zeros(n, np.int64)
    index = np.arange(n)
    for j in range(width - 1, -1, -1):
        np.copyto(place, index + j, where=grams[j : j + n] == least)
    whole = np.zeros(n, bool)
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        whole[a : max(a, b - WINDOW + 1)] = True
    windows = np.flatnonzero(whole)
    starts, lengths = runs(place[windows])
    anchors = place[windows][starts] if len(starts) else none
    return windows[starts] if len(starts) else none, lengths, anchors, grams[anchors]


class Automaton:
    """Suffix automaton of the segments so far. add() takes a segment and returns, for each of its words,
    how long the longest stretch is that ends there and occurs in what came before that word."""

    def __init__(self):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, words: list[bytes]) -> list[int]:
        nxt, link, length = self.next, self.link, self.length
        last, matched = 0, []
        for word in words:
            if word in nxt[last]:
                last = self._known(last, word)
                matched.append(length[last])
                continue
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and word not in nxt[p]:
                nxt[p][word] = cur
                p = link[p]
            if p != -1:
                link[cur] = self._known(p, word)
            last = cur
            matched.append(length[link[cur]])
        return matched

    def _known(self, p: int, word: bytes) -> int:
        """The state of p's longest string and the word; split off if it is shared with longer ones."""
        nxt, link, length = self.next, self.link, self.length
        q = nxt[p][word]
        if length[q] == length[p] + 1:
            return q
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = clone
        while p != -1 and nxt[p].get(word) == q:
            nxt[p][word] = clone
            p = link[p]
        return clone


def repeated_windows(segments: list[tuple], window: int = WINDOW) -> Iterator[tuple[bytes, int, int]]:
    """(key, first window, windows) that occur in an earlier segment. Segments are (anchor, order of the
    document, key, start, text), sorted; all windows of one segment hold the same anchor."""
    for _, group in groupby(segments, itemgetter(0)):
        seen: dict[bytes, None] = {}
        automaton = None
        for _, _, key, start, text in group:
            words = text.split(b" ")
            if text in seen:
                yield key, start, len(words) - window + 1
                continue
            if seen:
                if automaton is None:
                    automaton = Automaton()
                    automaton.add(next(iter(seen)).split(b" "))
                again = np.array(automaton.add(words)[window - 1 :]) >= window
                firsts, lengths = runs(again)
                yield from ((key, start + int(a), int(n)) for a, n in zip(firsts, lengths, strict=True) if again[a])
            seen[text] = None


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, SLICE):
        yield batch.slice(at, SLICE)


def _distinct(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """A row for each different sequence of WINDOW or more words: its key, first id and compressed text,
    in buckets of the key, so that later joins move only what is joined to it."""
    spark = docs.sparkSession

    def read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        keys, rows, blobs = [], [], []
        for row, text in enumerate(byte_texts(batch.column(1))):
            words = text.split()
            if len(words) >= WINDOW:
                keys.append(key_of(words))
                rows.append(row)
                blobs.append(press.compress(text))
        ids = batch.column(0).take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), ids, pa.array(blobs, pa.binary())], ["key", "id", "z"])

    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    texts = each_batch(source, read, f"key binary, id {source.schema['id'].dataType.simpleString()}, z binary")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "z")).alias("first")
    name = f"texts_{uuid.uuid4().hex}"
    kept = texts.groupBy("key").agg(first).select("key", "first.no_id", "first.id", "first.z")
    kept.write.bucketBy(partitions(spark), "key").option("path", shared_folder(spark)).option("compression", "none").saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name is only needed to say that there are buckets; the files stay
    return found


def _repeated_anchors(texts: DataFrame) -> DataFrame:
    """(key, at) of every anchor that occurs twice or more, and (null, null, hot) for those beyond HOT."""
    buckets = 4 * partitions(texts.sparkSession)

    def gather(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpress = zstandard.ZstdDecompressor()
        for part in _slices(batch):
            keys = part.column(0).to_pylist()
            split = [unpress.decompress(z).split() for z in part.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, split)])
            _, _, places, hashes = anchored(word_hashes([w for words in split for w in words]), ends)
            _, firsts, inverse, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
            owner = np.searchsorted(ends, places, "right") - 1
            names = np.frombuffer(b"".join(keys), f"V{KEY_BYTES}")
            entries = np.zeros(len(firsts), ENTRY)
            entries["anchor"], entries["key"] = hashes[firsts], names[owner[firsts]]
            entries["at"], entries["rows"] = places[firsts] - ends[owner[firsts]], counts
            again = np.setdiff1d(np.flatnonzero(counts[inverse] > 1), firsts)
            more = np.zeros(len(again), PLACE)
            more["key"], more["at"] = names[owner[again]], places[again] - ends[owner[again]]
            bucket = (entries["anchor"] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            starts, lengths = runs(bucket[order])
            blobs = [entries[order[a : a + n]].tobytes() for a, n in zip(starts, lengths, strict=True)]
            to = bucket[order][starts].astype(np.int32).tolist()
            if len(more):
                to.append(int(hashes[0] % np.uint64(buckets)))
                blobs.append(None)
            extra = [b""] * (len(to) - bool(len(more))) + [more.tobytes()] * bool(len(more))
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array([b or b"" for b in blobs], pa.binary()), pa.array(extra, pa.binary())], ["bucket", "entries", "places"])

    def decide(group: pa.Table) -> pa.Table:
        entries = np.frombuffer(b"".join(group.column("entries").to_pylist()), ENTRY)
        places = np.frombuffer(b"".join(group.column("places").to_pylist()), PLACE)
        entries = entries[np.argsort(entries["anchor"], kind="stable")]
        starts, lengths = runs(entries["anchor"])
        total = np.add.reduceat(entries["rows"].astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
        own = entries[np.repeat(total > 1, lengths)]
        hot = entries["anchor"][starts[total > HOT]].view(np.int64)
        keys = [x.tobytes() for x in own["key"]] + [x.tobytes() for x in places["key"]] + [None] * len(hot)
        at = np.concatenate([own["at"], places["at"]]).tolist() + [None] * len(hot)
        return pa.table({"key": pa.array(keys, pa.binary()), "at": pa.array(at, pa.int32()), "hot": pa.array([None] * (len(keys) - len(hot)) + hot.tolist(), pa.int64())})

    found = each_batch(texts.select("key", "z"), gather, "bucket int, entries binary, places binary")
    return stored(found.groupBy("bucket").applyInArrow(decide, "key binary, at int, hot long"))


def _repeats(texts: DataFrame) -> DataFrame:
    """(key, ranges): first window and number of windows of the stretches that occur earlier."""
    shards = 4 * partitions(texts.sparkSession)
    anchors = _repeated_anchors(texts)
    hot = texts.sparkSession.sparkContext.broadcast(np.sort(np.array([r[0] for r in anchors.where("hot is not null").select("hot").collect()], np.int64).view(np.uint64)))
    marked = texts.join(anchors.where("key is not null").groupBy("key").agg(F.collect_list("at").alias("at")), "key")

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in _slices(batch):
            yield _segments(part, hot.value, shards)

    def look(group: pa.Table) -> pa.Table:
        import zstandard

        unpress = zstandard.ZstdDecompressor()
        segments, found = [], []
        for blob in group.column("blob").to_pylist():
            rows, text, done = pickle.loads(unpress.decompress(blob))
            segments += [(*r, t) for r, t in zip(rows, text.split(b"\n"), strict=True)] if rows else []
            found += done
        segments.sort()
        found += repeated_windows(segments)
        return pa.table({"key": pa.array([f[0] for f in found], pa.binary()), "start": pa.array([f[1] for f in found], pa.int32()), "n": pa.array([f[2] for f in found], pa.int32())})

    cuts = each_batch(marked.select("key", "no_id", "id", "z", "at"), cut, "shard int, blob binary")
    found = cuts.groupBy("shard").applyInArrow(look, "key binary, start int, n int")
    return found.groupBy("key").agg(F.collect_list(F.struct("start", "n")).alias("ranges"))


def _segments(part: pa.RecordBatch, hot: np.ndarray, shards: int) -> pa.RecordBatch:
    """The segments around the marked anchors of some documents, by shard. Segments that equal an earlier
    one of the same documents are settled here, so that copies of one passage leave as one."""
    import xxhash
    import zstandard

    unpress, press = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
    keys, no_ids, ids, blobs, marks = (part.column(i).to_pylist() for i in range(5))
    ranked = sorted(range(len(keys)), key=lambda i: (no_ids[i], 0 if no_ids[i] else ids[i], keys[i]))
    rows: dict[int, list[tuple]] = {}
    texts: dict[int, list[bytes]] = {}
    done: dict[int, list[tuple]] = {}
    seen: set[tuple[int, bytes]] = set()
    for i in ranked:
        words = unpress.decompress(blobs[i]).split()
        order = (no_ids[i], 0 if no_ids[i] else ids[i], keys[i])
        firsts, lengths, places, hashes = anchored(word_hashes(words), np.array([0, len(words)]))
        take = np.flatnonzero(np.isin(places, marks[i]))
        every = np.isin(hashes, hot)
        for j in take.tolist():
            start, n, anchor = int(firsts[j]), int(lengths[j]), int(hashes[j])
            for a, m in [(start + k, 1) for k in range(n)] if every[j] else [(start, n)]:
                text = b" ".join(words[a : a + m + WINDOW - 1])
                name = xxhash.xxh3_64_intdigest(text) if every[j] else anchor
                if (name, text) in seen:
                    # Nothing is left to decide, so they go where their document leads, not to one shard.
                    done.setdefault(int.from_bytes(keys[i][:8], "little") % shards, []).append((keys[i], a, m))
                else:
                    seen.add((name, text))
                    rows.setdefault(name % shards, []).append((name, order, keys[i], a))
                    texts.setdefault(name % shards, []).append(text)
    to = sorted({*rows, *done})
    packed = [press.compress(pickle.dumps((rows.get(s, []), b"\n".join(texts.get(s, [])), done.get(s, [])))) for s in to]
    return pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(packed, pa.binary())], ["shard", "blob"])


def keep(words: list[bytes], ranges: list[dict]) -> np.ndarray:
    """Which words stay: those that no repeated window covers."""
    covered = np.zeros(len(words) + 1, np.int64)
    for r in ranges:
        covered[r["start"]] += 1
        covered[min(len(words), r["start"] + r["n"] + WINDOW - 1)] -= 1
    return np.cumsum(covered)[:-1] == 0


RESULT = "key binary, no_id boolean, first_id {kind}, n_removed long, sha256 string, kept binary"


def _cleaned(texts: DataFrame, with_text: bool) -> DataFrame:
    kind = texts.schema["id"].dataType.simpleString()

    def clean(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpress, press = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        removed, digests, kept = [], [], []
        for z, ranges in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
            words = unpress.decompress(z).split()
            if ranges:
                stay = keep(words, ranges)
                left = b" ".join(w for w, s in zip(words, stay.tolist(), strict=True) if s)
                removed.append(int(len(words) - stay.sum()))
                kept.append(press.compress(left) if with_text else None)
            else:
                left = b" ".join(words)
                removed.append(0)
                kept.append(z if with_text else None)
            digests.append(hashlib.sha256(left).hexdigest())
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(removed, pa.int64()), pa.array(digests), pa.array(kept, pa.binary())], ["key", "no_id", "first_id", "n_removed", "sha256", "kept"])

    joined = texts.join(_repeats(texts), "key", "left").select("key", "no_id", "id", "z", "ranges")
    return each_batch(joined, clean, RESULT.format(kind=kind))


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", with_text: bool = False) -> DataFrame:
    """(row, n_words, n_removed, kept_sha256, kept_text) of every row; row holds all columns but the text.

    A word goes if a window of WINDOW words covers it that also starts earlier: in a document of a
    smaller id, or before in the same one. Words are what ASCII white space separates; what is kept is
    joined by single spaces, but a text that loses nothing stays as it is. Null and empty texts have no
    words. Rows without an id come last. Rows with the same id and words are one document and fare
    alike; of different texts with the same id, the order is that of a hash of their words. kept_text
    is null unless asked for. Nothing is lost to hashing but by a collision of 96-bit keys or of 64-bit
    anchors, which only sends more text to be compared word by word.
    """
    texts = _distinct(docs, id_column, text_column)
    cleaned = _cleaned(texts, with_text)
    others = [c for c in docs.columns if c != text_column]
    source = docs.select(F.struct(*others).alias("row"), F.col(text_column).alias("text"))
    kind = source.schema["row"].dataType.simpleString()

    def read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, counts, digests, own = [], [], [], []
        for row, text in enumerate(byte_texts(batch.column(1))):
            words = text.split()
            short = len(words) < WINDOW
            # A longer key meets nothing; a null would send all short texts to one task of the join.
            keys.append(key_of(words) + row.to_bytes(4, "little") if short else key_of(words))
            counts.append(len(words))
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest() if short else None)
            own.append(short)
        mine = batch.column(1).filter(pa.array(own)) if with_text else None
        texts_of = iter(mine.to_pylist() if with_text else [])
        short_texts = pa.array([next(texts_of) if s and with_text else None for s in own], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), short_texts], ["row", "key", "n_words", "short_sha", "short_text"])

    rows = each_batch(source, read, f"row {kind}, key binary, n_words long, short_sha string, short_text string")
    joined = rows.join(cleaned, "key", "left")
    first = F.col(f"row.{id_column}").eqNullSafe(F.col("first_id"))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    short = F.col("short_sha").isNotNull()
    removed = F.when(short, 0).when(first, F.col("n_removed")).otherwise(F.col("n_words"))
    digest = F.when(short, F.col("short_sha")).when(first, F.col("sha256")).otherwise(empty)
    found = joined.select("row", "n_words", removed.cast("long").alias("n_removed"), digest.alias("kept_sha256"), F.when(first, F.col("kept")).alias("kept"), "short_text", short.alias("short"))
    if not with_text:
        return found.select("row", "n_words", "n_removed", "kept_sha256", F.lit(None).cast("string").alias("kept_text"))

    def unpack(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpress = zstandard.ZstdDecompressor()
        kept, shorts, is_short = (batch.column(i).to_pylist() for i in (4, 5, 6))
        texts = [t if s else unpress.decompress(z).decode() if z is not None else "" for z, t, s in zip(kept, shorts, is_short, strict=True)]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(texts, pa.string())], ["row", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return each_batch(found, unpack, f"row {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string")


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length_column: str | None = None) -> DataFrame:
    """All rows and columns, the text without repeated passages. A column of text lengths can be kept true.

    Null and empty texts, and such without a repeat, stay as they are; of rows that repeat the first in
    the order of `deduplicate` keeps its words; rows without id come last; an empty table stays empty."""
    found = deduplicate(docs, id_column, text_column, with_text=True)
    columns = []
    for c in docs.columns:
        if c == text_column:
            columns.append(F.col("kept_text").alias(c))
        elif c == length_column:
            kind = docs.schema[c].dataType
            columns.append(F.when(F.col("n_removed") > 0, F.length("kept_text").cast(kind)).otherwise(F.col("row").getField(c)).alias(c))
        else:
            columns.append(F.col("row").getField(c).alias(c))
    return found.select(*columns)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document; null texts and ids, repeats and empty tables as in `deduplicate`."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = deduplicate(docs)
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")
