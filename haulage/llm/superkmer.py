"""Operator 2: substring dedup by super-k-mer partitioning.

A word that lies in a window of ``WINDOW`` consecutive words is removed if that window also starts in a
document with a smaller id. The minimiser of a window is the smallest hash among its runs of
``MINIMISER`` words. Consecutive windows with one minimiser travel as one packed string (their words, once)
to the bucket of the minimiser, where sorting brings equal windows together; hashes order them and
the bytes decide.

1. *Settled in place.* Within a slice of a batch, only the windows of the slice's smallest document travel;
   later copies in the slice are known to be repeats. A passage in a third of all rows travels once per
   slice.
2. *Hot buckets.* Contexts around a common passage differ, so they do travel, all with the passage's
   minimisers. The bytes of all strings are summed first, in ``SLOTS`` slots of minimisers. The sum gives the number of
   buckets (``BUCKET_BYTES`` each) and of tasks (``TASK_BYTES`` each). A slot with over ``HOT`` times a bucket's mean is
   dissolved: its windows go one by one to buckets by their own hash. Equal windows still meet, since
   the bucket only hangs on the window.
3. *Bounded buckets.* A bucket that is larger all the same is read in parts of ``PART_BYTES``. Between parts its distinct
   windows stay, with the smallest document so far, as strings in which neighbours share their words. The next part is
   twice as large as what has stayed, so that time grows with the bucket and not with its square. Strings come in
   order of the smallest id of their slice; windows of ids that nothing later can undercut are kept once.
4. The spans found go back to their documents by their id (and 128 bits of hashes of the text, if ids repeat) in one
   join.

Defined results: a missing or empty text has no words. A missing id, or one of 2^63-1, counts as larger than any
other; ids that are no whole numbers end the query. Rows with equal ids are documents of their own, neither smaller
than the other; equal rows get equal results. Windows are judged on the input. An empty table gives an empty one. Added
columns come beside the row in ``doc``, so names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch
from .words import Words, as_bytes, gram_hashes, mix, pieces, sliding_min, whole_runs
from .workers import lean

WINDOW = 13
MINIMISER = 2
BUCKETS = 512  # at least; a power of two
SLOTS = 1 << 16  # in which super-k-mers are counted; a power of two
HOT = 4
LEVEL = 6  # of compression
SLICE_BYTES = 2 << 20
HASHED_BYTES = 1 << 20
PART_BYTES = 16 << 20
AT_ONCE = 1 << 19  # windows that are sorted at a time
BUCKET_BYTES = 8 << 20
TASK_BYTES = 256 << 20
RUN_BYTES = 28  # beside the text of a super-k-mer
OWN_SLICE = 8  # an id with more than this part of a slice's rows is a slice of its own
LAST = np.iinfo(np.int64).max  # stands for a missing id

SPAN = "id bigint, check1 bigint, check2 bigint, first int, last int"


class Runs:
    """Super-k-mers: the windows in line i of ``data`` from word ``start`` of document (``id``, ``check``) on."""

    def __init__(self, id, check, start, data: bytes):
        self.id, self.check, self.start, self.data = id, check, start, data

    def pack(self) -> bytes:
        steps = np.diff(self.id, prepend=0)  # ids come in order; small steps pack well
        head = [np.array([len(self.id)], np.int64), steps, self.check, self.start]
        raw = b"".join([*(np.ascontiguousarray(a).tobytes() for a in head), self.data])
        return zstandard.ZstdCompressor(level=LEVEL).compress(raw)

    @staticmethod
    def unpack(blob: bytes) -> Runs:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        id = np.cumsum(np.frombuffer(raw, np.int64, n, 8))
        check = np.frombuffer(raw, np.int64, 2 * n, 8 + 8 * n).reshape(n, 2)
        return Runs(id, check, np.frombuffer(raw, np.int32, n, 8 + 24 * n), raw[8 + 28 * n:])

    @staticmethod
    def together(parts: list[Runs]) -> Runs:
        """All of them; the list is emptied."""
        arrays = [np.concatenate([getattr(p, c) for p in parts]) for c in ("id", "check", "start")]
        data = [p.data for p in parts]
        parts.clear()
        return Runs(*arrays, b"".join(data))


def _lines(data: bytes, starts, ends) -> bytes:
    """Stretches of ``data`` as lines."""
    return b"\n".join([*(data[s:e] for s, e in zip(starts.tolist(), ends.tolist())), b""])


class Windows:
    """The windows of some texts: first word, hash, minimiser."""

    def __init__(self, words: Words, window: int):
        h = words.hashes()
        self.at = whole_runs(words, window)
        self.hash = gram_hashes(h, window)[self.at] if len(self.at) else h[:0]
        grams = gram_hashes(h, MINIMISER)
        self.least = sliding_min(grams, window - MINIMISER + 1)[self.at] if len(self.at) else h[:0]


def _repeats(data: bytes, start: np.ndarray, end: np.ndarray, hash: np.ndarray, id: np.ndarray):
    """``later``: windows with an equal one in a smaller document; ``same``: those of the smallest one;
    ``twin``: windows whose hash is there twice or more.

    Window i is ``data[start[i]:end[i]]`` of document ``id[i]``. Windows are sorted by (hash, id); bytes are
    compared with the first of the run of equal hashes. Should another content share its hash, it is told
    apart by its bytes.
    """
    order = np.lexsort((id, hash)).astype(np.int32)
    h, d = hash[order], id[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[1:] != h[:-1]
    del h
    first = np.maximum.accumulate(np.where(new, np.arange(len(d), dtype=np.int32), np.int32(0)))
    later, same = np.zeros(len(d), dtype=bool), np.ones(len(d), dtype=bool)
    twin = np.zeros(len(d), dtype=bool)
    again = np.flatnonzero(~new)
    twin[order[again]] = twin[order[first[again]]] = True
    at, of = order[again], order[first[again]]
    odd: set[int] = set()
    for k, a, b, c, e in zip(first[again].tolist(), start[at].tolist(), end[at].tolist(),
                             start[of].tolist(), end[of].tolist()):
        if data[a:b] != data[c:e]:
            odd.add(k)
    later[order] = d > d[first]
    same[order] = d == d[first]
    for f in odd:
        run = order[f:int(np.searchsorted(first, f, side="right"))]
        least: dict[bytes, int] = {}
        for k in run.tolist():
            later[k] = id[k] > least.setdefault(data[start[k]:end[k]], id[k])
            same[k] = not later[k]
    return later, same, twin


def _spans(start: np.ndarray, group: np.ndarray, window: int):
    """Runs of consecutive windows of one group as (index of first, first word, last word)."""
    if not len(start):
        return start, start, start
    cut = np.ones(len(start), dtype=bool)
    cut[1:] = (group[1:] != group[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(cut)
    last = np.concatenate((first[1:], [len(start)])) - 1
    return first, start[first], start[last] + window - 1


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(pc.fill_null(batch.column("id"), LAST), dtype=np.int64)


def _checks(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([np.asarray(batch.column(c), dtype=np.int64) for c in ("check1", "check2")])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices in order of their ids. Rows that agree in id and text count once, since they get one result;
    an id that holds much of a slice, such as the missing one, gets a slice of its own."""
    for part in pieces(batches, "text", SLICE_BYTES):
        part = part.take(pa.array(np.argsort(_ids(part), kind="stable")))
        id, check = _ids(part), _checks(part)
        if len(id) > 1 and (id[1:] == id[:-1]).any():
            order = np.lexsort((check[:, 1], check[:, 0], id))
            key = np.column_stack([id, check])[order]
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]).any(axis=1)
            part = part.take(pa.array(order[new]))
            id = _ids(part)
        new = np.ones(len(id), dtype=bool)
        new[1:] = id[1:] != id[:-1]
        first = np.flatnonzero(new)
        size = np.diff(first, append=len(id))
        many = (size > 1) & (OWN_SLICE * size > len(id))
        cuts = np.unique(np.concatenate(([0], first[many], (first + size)[many], [len(id)]))).tolist()
        for a, b in zip(cuts, cuts[1:]):
            yield part.slice(a, b - a)


def _runs(words: Words, wins: Windows, travels: np.ndarray, buckets: int, hot: np.ndarray, window: int):
    """First and last window (places in ``wins``) and bucket of every super-k-mer."""
    t = np.flatnonzero(travels)
    if not len(t):
        return t, t, t
    at, least, row = wins.at[t], wins.least[t], words.row[wins.at[t]]
    place = mix(least)
    single = np.isin((place % np.uint64(SLOTS)).astype(np.int64), hot)
    bucket = (place % np.uint64(buckets)).astype(np.int64)
    bucket[single] = (wins.hash[t[single]] % np.uint64(buckets)).astype(np.int64)
    cut = np.ones(len(t), dtype=bool)
    cut[1:] = (at[1:] != at[:-1] + 1) | (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | single[1:]
    first = np.flatnonzero(cut)
    last = np.concatenate((first[1:], [len(t)])) - 1
    return t[first], t[last], bucket[first]


def _count(window: int):
    """Bytes of super-k-mers in every slot that has some."""
    none = np.zeros(0, dtype=np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, dtype=np.int64)
        for part in pieces(batches, "text", SLICE_BYTES):
            words = Words(as_bytes(part.column("text")))
            wins = Windows(words, window)
            first, last, slot = _runs(words, wins, np.ones(len(wins.at), dtype=bool), SLOTS, none, window)
            if len(first):
                size = words.end[wins.at[last] + window - 1] - words.start[wins.at[first]]
                total += np.bincount(slot, weights=size, minlength=SLOTS).astype(np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["slot", "size"])

    return count


def _deal(buckets: int, hot: np.ndarray, window: int):
    """Per slice: repeats known already (a bucket below 0, packed as spans) and a blob for every bucket."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            id, check = _ids(part), _checks(part)
            words = Words(as_bytes(part.column("text")))
            wins = Windows(words, window)
            row = words.row[wins.at]
            start, end = words.start[wins.at], words.end[wins.at + window - 1] if len(row) else row
            begins = (wins.at - words.first[row]).astype(np.int32)
            later, travels, _ = _repeats(words.data, start, end, wins.hash, id[row])
            found = np.flatnonzero(later)
            if len(found):
                k, first, last = _spans(begins[found], row[found], window)
                at = row[found[k]]
                spans = Runs(id[at], check[at], first.astype(np.int32), b"".join([b"%d\n" % x for x in last.tolist()]))
                yield _rows([-1 - int(id[0]) % buckets], [spans.pack()], int(id[0]))
            first, last, bucket = _runs(words, wins, travels, buckets, hot, window)
            order = np.argsort(bucket, kind="stable")
            first, last, bucket = first[order], last[order], bucket[order]
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]))
            row, begins, start, end, data = row[first], begins[first], start[first], end[last], words.data
            del words, wins, later, travels, first, last, order
            numbers, blobs, size = [], [], 0
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if a < b:
                    numbers.append(int(bucket[a]))
                    runs = Runs(id[row[a:b]], check[row[a:b]], begins[a:b], _lines(data, start[a:b], end[a:b]))
                    blobs.append(runs.pack())
                    size += len(blobs[-1])
                    if size > SLICE_BYTES:
                        yield _rows(numbers, blobs, int(id[0]))
                        numbers, blobs, size = [], [], 0
            yield _rows(numbers, blobs, int(id[0]))

    return deal


def _rows(buckets: list[int], blobs: list[bytes], least: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int64()), pa.array([least] * len(blobs), pa.int64()), pa.array(blobs, pa.binary())],
        ["bucket", "least", "blob"],
    )


def _placed(runs: Runs, window: int):
    """Every window's hash, run, first word, and first and last byte. Some of the text is looked at a time."""
    parts, at, run = [], 0, 0
    while at < len(runs.data):
        stop = runs.data.find(b"\n", min(at + HASHED_BYTES, len(runs.data)) - 1) + 1
        words = Words.of_lines(runs.data[at:stop])
        i = whole_runs(words, window)
        if len(i):
            row = words.row[i]
            begin = runs.start[run + row] + (i - words.first[row])
            parts.append((gram_hashes(words.hashes(), window)[i], (run + row).astype(np.int32), begin.astype(np.int32),
                          (at + words.start[i]).astype(np.int32), (at + words.end[i + window - 1]).astype(np.int32)))
        run += len(words.first) - 1
        at = stop
    if not parts:
        none = np.zeros(0, np.int32)
        return none.astype(np.uint64), none, none, none, none
    columns = [list(c) for c in zip(*parts)]
    parts.clear()
    return [np.concatenate(columns.pop(0)) for _ in range(5)]


def settle(runs: Runs, window: int, final: int | None = None) -> tuple[pa.RecordBatch, Callable[[], Runs]]:
    """Spans of later copies in one bucket, and the windows that stand for their content.

    What comes later in the bucket has ids of ``final`` or more. So a window of such an id or a smaller one stays,
    and for later ones, one copy of it is enough.
    """
    hash, run, begin, start, end = _placed(runs, window)
    later, same, twin = (np.zeros(len(hash), dtype=bool) for _ in range(3))
    parts = 1 + len(hash) // AT_ONCE
    of = (hash >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    for p in range(parts):  # equal windows are in one part
        some = np.flatnonzero(of == p)
        later[some], same[some], twin[some] = _repeats(
            runs.data, start[some], end[some], hash[some], runs.id[run[some]])
    del of
    found = np.flatnonzero(later)
    k, first, last = _spans(begin[found], run[found], window)
    of = run[found[k]]
    spans = _span_rows(runs.id[of], runs.check[of], first, last)

    def leaders() -> Runs:
        kept, some = np.flatnonzero(same), np.flatnonzero(same & twin)
        id, check = runs.id[run[some]], runs.check[run[some]]
        once = np.lexsort((begin[some], *check.T, id, hash[some]))
        some, id, check = some[once], id[once], check[once]
        alike = (begin[some[1:]] == begin[some[:-1]]) & (check[1:] == check[:-1]).all(axis=1)
        if final is not None:
            alike |= id[1:] <= final
        alike &= (hash[some[1:]] == hash[some[:-1]]) & (id[1:] == id[:-1])
        # Hashes found these; only equal bytes make them copies.
        pairs = zip(some[1:][alike].tolist(), some[:-1][alike].tolist())
        gone = [a for a, b in pairs if runs.data[start[a]:end[a]] == runs.data[start[b]:end[b]]]
        kept = np.setdiff1d(kept, gone, assume_unique=True)
        k, first, last = _spans(begin[kept], run[kept], window)
        a, b = kept[k], kept[np.append(k[1:], len(kept)) - 1] if len(k) else kept[k]
        return Runs(runs.id[run[a]], runs.check[run[a]], begin[a], _lines(runs.data, start[a], end[b]))

    return spans, leaders


def _span_rows(id, check, first, last) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(id), pa.array(check[:, 0]), pa.array(check[:, 1]), pa.array(first.astype(np.int32)),
         pa.array(last.astype(np.int32))], ["id", "check1", "check2", "first", "last"],
    )


def _settle(window: int):
    def settle_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size, bound = None, [], 0, PART_BYTES
        for batch in batches:
            for bucket, least, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "least", "blob"))):
                runs = Runs.unpack(blob)
                if bucket < 0:  # spans that were settled in place
                    last = np.array(runs.data.split(b"\n")[:-1]).astype(np.int32)
                    yield _span_rows(runs.id, runs.check, runs.start, last)
                    continue
                if bucket != now and held:
                    yield settle(Runs.together(held), window)[0]
                    held, size, bound = [], 0, PART_BYTES
                now = bucket
                held.append(runs)
                size += len(runs.data) + RUN_BYTES * len(runs.id)
                if size > bound:
                    spans, leaders = settle(Runs.together(held), window, least)
                    yield spans
                    held = [leaders()]
                    size = len(held[0].data) + RUN_BYTES * len(held[0].id)
                    bound = max(PART_BYTES, 2 * size)  # so that no window is settled more often than a few times
        if held:
            yield settle(Runs.together(held), window)[0]

    return settle_buckets


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds n_words, n_removed and kept_text to each row."""
    for batch in batches:
        for part in pieces([batch], "text"):
            counts, removed, kept = [], [], []
            for text, spans in zip(as_bytes(part.column("text")), part.column("spans").to_pylist()):
                words = text.split() if text else []
                counts.append(len(words))
                if spans:
                    upto, left = 0, []
                    for s in sorted(spans, key=lambda s: s["first"]):
                        left += words[upto:max(upto, s["first"])]
                        upto = max(upto, s["last"] + 1)
                    words = left + words[upto:]
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc", "n_words", "n_removed", "kept_text"],
            )


def _text_checks(text: Column, alone: bool) -> list[Column]:
    """128 bits that tell rows apart that share an id; where all ids differ, they would just travel."""
    if alone:
        return [F.lit(0).cast("bigint").alias(c) for c in ("check1", "check2")]
    return [F.xxhash64(F.lit(seed), text).alias(c) for seed, c in enumerate(("check1", "check2"))]


def repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW,
            buckets: int = BUCKETS) -> DataFrame:
    """Every row's ``doc``, ``n_words``, ``n_removed`` and ``kept_text`` (kept words, one space between)."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = F.col(id).cast("bigint")
    alone = docs.groupBy(number.alias("id")).count().where("count > 1").isEmpty()
    checks = _text_checks(F.col(text), alone)
    rows = docs.select(number.alias("id"), *checks, F.col(text).alias("text"))
    with Scratch(spark) as tables:
        sizes = tables.write(
            rows.select("text").mapInArrow(lean(_count(window)), "slot bigint, size bigint")
            .groupBy("slot").agg(F.sum("size").alias("size")))
        total = sizes.agg(F.sum("size")).first()[0] or 0
        while buckets < max(4 * parts, total // BUCKET_BYTES):
            buckets *= 2
        much = HOT * (total // min(buckets, SLOTS))
        # At most SLOTS / HOT numbers come to the driver, whatever the input.
        hot = np.array([r.slot for r in sizes.where(F.col("size") > much).collect()], dtype=np.int64)
    parts = max(parts, total // TASK_BYTES)
    dealt = rows.mapInArrow(lean(_deal(buckets, hot, window)), "bucket bigint, least bigint, blob binary")
    spans = dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", "least") \
        .mapInArrow(lean(_settle(window)), SPAN) \
        .groupBy("id", "check1", "check2").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    whole = docs.select(
        F.struct("*").alias("doc"), *(c.alias(f"of_{i}") for i, c in enumerate(checks)),
        F.coalesce(number, F.lit(int(LAST))).alias("of_id"),
    )
    joined = whole.join(spans, (F.col("of_id") == F.col("id")) & (F.col("of_0") == F.col("check1"))
                        & (F.col("of_1") == F.col("check2")), "left")
    doc = joined.schema["doc"].dataType.simpleString()
    return joined.select("doc", F.col("doc")[text].alias("text"), "spans").mapInArrow(
        lean(_keep), f"doc {doc}, n_words bigint, n_removed bigint, kept_text string"
    )


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without their repeats; a text that loses no word stays as it was."""
    out = repeats(docs, id, text)
    put = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("doc")[text])
    return out.select(*[put.alias(c) if c == text else F.col("doc")[c].alias(c) for c in docs.columns])


def op2_superkmer(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return repeats(docs).select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "n_removed",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE_SQL = r"""
WITH split AS (
    SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+') IF x <> ''] AS words
    FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM split WHERE len(words) >= 13)
), found AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY w) AS least FROM windows)
    WHERE doc_id > least
), covered AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM found
), placed AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM split
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
    FROM placed ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id
)
SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(len(words) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k USING (doc_id)
"""
