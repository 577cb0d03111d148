"""Operator 4: language by interpolated Kneser-Ney models of characters.

Texts are lower-cased letters with one space for anything between them. Every training text is counted
whole, in runs of ``ORDER`` characters; lower orders are continuation counts of those. A character is a unit of UTF-16, so
letters beyond the first 65,536 are two, and no two letters look alike. A run is one number, its characters side by
side, so contexts and suffixes are bit operations. The model keeps, for each order, the sorted numbers of the runs of any language with their
interpolated log probabilities in all of them, and the back-off weights of contexts; one binary search per
character finds both, or goes down an order.

A text's language is the one with the lowest cross-entropy per character, in a model of all training rows. A first model
leaves out one part in ``CALIBRATION`` of them: on these, the sharpness that turns entropies
into a score is chosen by log loss, and for each language the entropy that one in a thousand of
its texts exceeds; texts above are marked as ``rejected`` (none, for a language without such texts). Counting, smoothing sums and calibration are
Spark aggregations over all rows. The model is tables of every run and context of each order, and grows with the
corpus. The driver and the tasks get the languages, single statistics and of each table at most ``MODEL_RUNS``
rows, the most frequent ones. Runs of a text that these do not settle are joined with the tables, so that
the results do not depend on what was held.

Defined results: a missing text or one without letters is ``und`` with score 0; rows with a missing language
are not learned from; without any training row every text is ``und``; equal entropies go to the first
language by name; rows are judged each; an empty table gives an empty one.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, Scratch, small, written
from .words import pieces

ORDER = 4
BITS = 16
MODEL_RUNS, MODEL_CELLS = 1_000_000, 8_000_000  # of an order in each task's part of the model: runs, and runs times languages
CALIBRATION = 64
REJECTED = 0.001
UNKNOWN = "und"
SHARPNESS = [1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0, 128.0]
SLICE_BYTES = 2 << 20


@functools.cache
def _letters() -> np.ndarray:
    """Lower case of every letter, 0 for other characters."""
    out = np.zeros(0x110000, dtype=np.int64)
    for c in range(0x110000):
        if chr(c).isalpha():
            out[c] = ord(chr(c).lower()[0])
    return out


def _shorter(key: np.ndarray) -> np.ndarray:
    """Runs without their last character. A run of four may fill all 64 bits."""
    return (key.view(np.uint64) >> np.uint64(BITS)).view(np.int64)


def runs(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of ``ORDER`` characters ending at each letter or space, their texts, and letters per text.

    A text begins with ``ORDER - 1`` spaces and ends with one.
    """
    edge = "\0" * (ORDER - 1)
    lengths = np.array([len(t or "") + ORDER for t in texts], dtype=np.int64)
    codes = _letters()[np.frombuffer("".join([edge + (t or "") + "\0" for t in texts]).encode("utf-32-le", "surrogatepass"), "<u4")]
    row = np.repeat(np.arange(len(texts)), lengths)
    first = np.zeros(len(codes), dtype=bool)
    begin = np.cumsum(lengths) - lengths
    for k in range(ORDER - 1):
        first[begin + k] = True
    keep = first | (codes > 0)
    keep[1:] |= codes[:-1] > 0  # a space after a letter stands for all up to the next
    codes, row, first = codes[keep], row[keep], first[keep]
    letters = np.bincount(row[codes > 0], minlength=len(texts))
    wide = codes > 0xFFFF
    if wide.any():
        units = 1 + wide
        second = np.cumsum(units)[wide] - 1
        codes, row, first = (np.repeat(x, units) for x in (codes, row, first))
        over = codes[second] - 0x10000
        codes[second - 1], codes[second] = 0xD800 | over >> 10, 0xDC00 | over & 0x3FF
    key = codes.copy()
    for k in range(1, ORDER):
        key[k:] |= codes[:-k] << (BITS * k)
    return key[~first], row[~first], letters


def _count(languages: list[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text", 4 * SLICE_BYTES):
            key, row, _ = runs(part.column("text").to_pylist())
            kind = np.array([2 * languages.index(x) + a for x, a in zip(part.column("lang").to_pylist(), part.column("aside").to_pylist())],
                            dtype=np.int32)[row]
            for i in np.unique(kind).tolist():
                keys, n = np.unique(key[kind == i], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), i // 2, np.int32)), pa.array(np.full(len(keys), i % 2 > 0)), pa.array(keys), pa.array(n)],
                    ["lang", "aside", "key", "n"],
                )

    return count


class Model:
    """Sorted runs of each order with their log probabilities, and contexts with their back-off weights.

    This is the part of the model that travels to the tasks; ``parts`` has the tables of all runs and contexts.
    What cannot be told from the part alone is NaN.
    """

    def __init__(self, languages: list[str]):
        self.languages = languages
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        self.contexts: list[tuple[np.ndarray, np.ndarray]] = []
        self.all_runs: list[bool] = []
        self.all_contexts: list[bool] = []
        self.parts: list[tuple[DataFrame, DataFrame]] = []
        self.learnt = np.zeros(len(languages), dtype=bool)
        self.sharpness, self.limit = 16.0, np.full(len(languages), np.inf)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"parts": []}

    def log_probability(self, key: np.ndarray, order: int) -> np.ndarray:
        """In every language, of the last character of runs of ``order`` characters given the others."""
        if order == 0:
            return np.full((len(key), len(self.languages)), self.floor, dtype=np.float32)
        known, values = self.runs[order - 1]
        at = np.minimum(np.searchsorted(known, key), max(0, len(known) - 1))
        found = known[at] == key if len(known) else np.zeros(len(key), dtype=bool)
        if found.all():
            return values[at]
        out = np.full((len(key), len(self.languages)), np.nan, dtype=np.float32)
        out[found] = values[at[found]]
        if self.all_runs[order - 1]:
            out[~found] = self._backed_off(key[~found], order)
        return out

    def _backed_off(self, key: np.ndarray, order: int) -> np.ndarray:
        known, weights = self.contexts[order - 1]
        lower = self.log_probability(key & ((1 << BITS * (order - 1)) - 1), order - 1)
        context = _shorter(key)
        at = np.minimum(np.searchsorted(known, context), max(0, len(known) - 1))
        found = known[at] == context if len(known) else np.zeros(len(key), dtype=bool)
        out = lower.copy()
        out[found] += weights[at[found]]
        if not self.all_contexts[order - 1]:
            out[~found] = np.nan
        return out

    def add_order(self, runs: DataFrame, contexts: DataFrame) -> None:
        """Keeps the tables, and in the part their most frequent rows."""
        self.parts.append((runs, contexts))
        for table, held, whole in ((runs, self.runs, self.all_runs), (contexts, self.contexts, self.all_contexts)):
            rows, all_rows = _most(table, max(1, min(MODEL_RUNS, MODEL_CELLS // len(self.languages))))
            key = rows.column("key").to_numpy()
            values = rows.column("values").combine_chunks().flatten().to_numpy().reshape(len(key), len(self.languages))
            order = np.argsort(key)
            held.append((key[order], values[order]))
            whole.append(all_rows)

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each row's text: letters, characters, summed log probabilities, and the runs that are not in them."""
        for part in pieces(batches, "text", SLICE_BYTES):
            key, row, letters = runs(part.column("text").to_pylist())
            out = np.zeros((part.num_rows, len(self.languages)))
            missed, times, ends = key[:0], row[:0], np.zeros(part.num_rows + 1, np.int32)
            if len(key) and self.languages:
                values = self.log_probability(key, ORDER)
                gone = np.isnan(values).any(axis=1)
                if gone.any():
                    values[gone] = 0
                    order = np.lexsort((key[gone], row[gone]))
                    missed, of = key[gone][order], row[gone][order]
                    new = np.flatnonzero(np.append(True, (missed[1:] != missed[:-1]) | (of[1:] != of[:-1])))
                    times, missed = np.diff(np.append(new, len(missed))), missed[new]
                    ends[1:] = np.cumsum(np.bincount(of[new], minlength=part.num_rows))
                first = np.flatnonzero(np.diff(row, prepend=-1))
                out[row[first]] = np.add.reduceat(values, first, axis=0, dtype=np.float64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), pa.array(letters), pa.array(np.bincount(row, minlength=part.num_rows)),
                 pa.array(out.tolist(), pa.list_(pa.float64())), pa.ListArray.from_arrays(ends, pa.array(missed)),
                 pa.ListArray.from_arrays(ends, pa.array(times))],
                ["doc", "letters", "size", "sums", "missed", "times"],
            )

    def sums_schema(self, kind: str) -> str:
        return f"doc {kind}, letters bigint, size bigint, sums array<double>, missed array<bigint>, times array<bigint>"

    def entropies(self, batch: pa.RecordBatch) -> np.ndarray:
        """Cross-entropy per character in every language of a batch of sums; infinite without anything learnt."""
        sums = batch.column("sums").flatten().to_numpy().reshape(batch.num_rows, len(self.languages))
        return np.where(self.learnt, -sums / np.maximum(batch.column("size").to_numpy(), 1)[:, None], np.inf)


def _array(values) -> Column:
    return F.array(*values)


def counts(rows: DataFrame, languages: list[str], tables: Scratch) -> DataFrame:
    """Runs of ``rows``' texts by language. ``text`` and ``lang`` are not missing; rows ``aside`` are counted apart."""
    found = rows.select("text", "lang", "aside").mapInArrow(_count(languages), "lang int, aside boolean, key bigint, n bigint")
    return tables.write(found.groupBy("lang", "aside", "key").agg(F.sum("n").alias("n")))


def train(grams: DataFrame, languages: list[str], tables: Scratch) -> Model:
    """The model of the counted runs ``lang``, ``key``, ``n``. Languages without any are not learnt; if none is, there is no model."""
    learnt = [r.lang for r in grams.select("lang").distinct().collect()]
    model = Model(languages if learnt else [])
    if not learnt:
        return model
    model.learnt[learnt] = True
    orders = [grams]
    for order in range(ORDER - 1, 0, -1):
        short = F.col("key").bitwiseAND(F.lit((1 << BITS * order) - 1))
        orders.append(tables.write(orders[-1].groupBy("lang", short.alias("key")).agg(F.count("*").alias("n"))))
    letters = orders[-1].agg(F.count_distinct("key")).first()[0]
    model.floor = -float(np.log(letters + 1))
    each = range(len(languages))
    for order, table in enumerate(reversed(orders), 1):
        once = table.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("a"), F.count_if(F.col("n") == 2).alias("b"))
        discount = np.full(len(languages), 0.5)
        for r in once.collect():
            if r.a and r.b:
                discount[r.lang] = r.a / (r.a + 2 * r.b)

        def of(lang: int, what: Column) -> Column:
            return F.coalesce(F.sum(F.when(F.col("lang") == lang, what)), F.lit(0)).cast("double")

        contexts = tables.write(table.groupBy(F.shiftrightunsigned("key", BITS).alias("key")).agg(
            F.sum("n").alias("n"), _array(of(i, F.col("n")) for i in each).alias("total"),
            _array(of(i, F.lit(1)) for i in each).alias("types"),
        ).mapInArrow(_weights(discount), "key bigint, n bigint, total array<double>, values array<float>"))
        joined = table.groupBy("key").agg(F.sum("n").alias("n"), _array(of(i, F.col("n")) for i in each).alias("own")) \
            .join(_small(contexts.select(F.col("key").alias("context"), "total", F.col("values").alias("weight")), model),
                  F.shiftrightunsigned("key", BITS) == F.col("context"))
        if order > 1:
            below = model.parts[-1][0].select(F.col("key").alias("suffix"), F.col("values").alias("lower"))
            joined = joined.join(_small(below, model), F.col("key").bitwiseAND(F.lit((1 << BITS * (order - 1)) - 1)) == F.col("suffix"))
        else:
            joined = joined.withColumn("lower", _array(F.lit(model.floor).cast("float") for _ in each))
        full = joined.select("key", "n", "own", "total", "weight", "lower") \
            .mapInArrow(_interpolated(discount), "key bigint, n bigint, values array<float>")
        model.add_order(tables.write(full), contexts)
    return model


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.float64)


def _floats(values: np.ndarray) -> pa.Array:
    rows, width = values.shape
    return pa.ListArray.from_arrays(np.arange(rows + 1, dtype=np.int32) * width, pa.array(values.astype(np.float32).ravel()))


def _weights(discount: np.ndarray):
    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                total, types = _matrix(b, "total"), _matrix(b, "types")
                # A context that a language lacks leaves everything to the lower order.
                weight = np.where(total > 0, discount * types / np.maximum(total, 1), 1.0)
                yield pa.RecordBatch.from_arrays([b.column("key"), b.column("n"), b.column("total"), _floats(np.log(weight))],
                                                 ["key", "n", "total", "values"])

    return weights


def _interpolated(discount: np.ndarray):
    def interpolated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                total = _matrix(b, "total")
                own = np.where(total > 0, np.maximum(_matrix(b, "own") - discount, 0) / np.maximum(total, 1), 0.0)
                values = np.log(own + np.exp(_matrix(b, "weight") + _matrix(b, "lower")))
                yield pa.RecordBatch.from_arrays([b.column("key"), b.column("n"), _floats(values)], ["key", "n", "values"])

    return interpolated


def _small(table: DataFrame, model: Model) -> DataFrame:
    return small(table, BROADCAST_ROWS // (4 * len(model.languages)))


def _most(table: DataFrame, limit: int) -> tuple[pa.Table, bool]:
    """At most ``limit`` rows, those with the highest counts, and whether they are all."""
    level = F.floor(F.log2("n") * 16)
    left, least = limit, None
    levels = table.groupBy(level.alias("level")).count().collect()
    for r in sorted(levels, key=lambda r: -r.level):
        left -= r["count"]
        if left < 0:
            break
        least = r.level
    whole = left >= 0
    chosen = table if whole else table.where(level >= least) if least is not None else table.where("false")
    return chosen.select("key", "values").toArrow(), whole


def _looked_up(keys: DataFrame, model: Model, order: int, tables: Scratch) -> DataFrame:
    """``key`` and ``values`` of different runs of ``order`` characters, by the tables of the whole model."""
    all_runs, all_contexts = model.parts[order - 1]
    keys = tables.write(keys.join(all_runs.select("key", "values"), "key", "left"))
    weights = all_contexts.select(F.col("key").alias("context"), F.col("values").alias("weight"))
    rest = keys.where("values IS NULL").select("key", F.shiftrightunsigned("key", BITS).alias("context")).join(_small(weights, model), "context", "left")
    if order == 1:
        rest = rest.withColumn("lower", _array(F.lit(model.floor).cast("float") for _ in model.languages))
    else:
        rest = rest.withColumn("suffix", F.col("key").bitwiseAND(F.lit((1 << BITS * (order - 1)) - 1)))
        lower = tables.write(_looked_up(rest.select(F.col("suffix").alias("key")).distinct(), model, order - 1, tables))
        rest = rest.join(_small(lower.select(F.col("key").alias("suffix"), F.col("values").alias("lower")), model), "suffix")
    added = F.when(F.col("weight").isNull(), F.col("lower")).otherwise(F.zip_with("lower", "weight", lambda a, b: a + b))
    return keys.where("values IS NOT NULL").union(rest.select("key", added.alias("values")))


def _by_tables(rows: DataFrame, model: Model, tables: Scratch) -> DataFrame:
    """Rows of ``doc`` and ``text`` as rows of sums, the runs that the part lacks joined with the whole model's."""
    kind = rows.schema["doc"].dataType.simpleString()
    seen = tables.write(rows.mapInArrow(model.sums, model.sums_schema(kind)).withColumn("row", F.monotonically_increasing_id()))
    if not model.languages:
        return seen
    missed = seen.select("row", F.explode(F.arrays_zip("missed", "times")).alias("x")).select("row", "x.missed", "x.times")
    values = tables.write(_looked_up(missed.select(F.col("missed").alias("key")).distinct(), model, ORDER, tables))
    product = [F.sum(F.get("values", F.lit(i)).cast("double") * F.col("times")) for i in range(len(model.languages))]
    more = missed.join(values, F.col("missed") == F.col("key")).groupBy("row").agg(_array(product).alias("more"))
    both = F.when(F.col("more").isNull(), F.col("sums")).otherwise(F.zip_with("sums", "more", lambda a, b: a + b))
    return seen.join(more, "row", "left").select("doc", "letters", "size", both.alias("sums"))


def _score(model: Model):
    languages = model.languages

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            n, letters = part.num_rows, part.column("letters").to_numpy()
            pred, p, rejected = [UNKNOWN] * n, np.zeros(n), np.zeros(n, dtype=bool)
            entropy = np.zeros(n)
            if languages and n:
                all_entropies = model.entropies(part)
                best = all_entropies.argmin(axis=1)
                entropy = all_entropies.min(axis=1)
                weights = np.exp(-model.sharpness * (all_entropies - entropy[:, None]))
                p = np.where(letters > 0, 1 / weights.sum(axis=1), 0.0)
                pred = [languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), letters.tolist())]
                rejected = (letters == 0) | (entropy > model.limit[best])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), pa.array(pred, pa.string()), pa.array(p), pa.array(entropy), pa.array(rejected)],
                ["doc", "lang_pred", "score", "entropy", "rejected"],
            )

    return score


def _calibrated(model: Model, rows: DataFrame, tables: Scratch) -> tuple[float, np.ndarray]:
    """Sharpness and limits by rows that the model has not seen, of the languages that it has learnt."""
    languages, sharpness, limit = model.languages, model.sharpness, model.limit.copy()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            entropies, letters = model.entropies(part), part.column("letters").to_numpy()
            names = part.column("doc").field("lang").to_pylist()
            lang = np.array([languages.index(x) for x in names], dtype=np.int64)
            ok = np.flatnonzero((letters > 0) & model.learnt[lang])
            own = entropies[ok, lang[ok]]
            worse = entropies[ok] - own[:, None]
            loss = np.stack([np.log(np.exp(np.minimum(-s * worse, 500)).sum(axis=1)) for s in SHARPNESS], axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang[ok].astype(np.int32)), pa.array(own), pa.array(loss.tolist(), pa.list_(pa.float64()))],
                ["lang", "own", "loss"],
            )

    rows = rows.select(F.struct("lang").alias("doc"), "text")
    seen = tables.write(_by_tables(rows, model, tables).mapInArrow(measure, "lang int, own double, loss array<double>"))
    losses = seen.agg(*[F.avg(F.get("loss", F.lit(i))).alias(f"l{i}") for i in range(len(SHARPNESS))]).first()
    if losses[0] is not None:
        sharpness = SHARPNESS[int(np.argmin(losses))]
    for r in seen.groupBy("lang").agg(F.percentile_approx("own", 1 - REJECTED, 10000).alias("q")).collect():
        limit[r.lang] = r.q
    return sharpness, limit


def identify(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", id: str = "doc_id") -> DataFrame:
    """Every row's ``doc`` (without its text), ``lang_pred``, ``score``, ``entropy`` and ``rejected``.

    Learns from the rows for which ``learn`` is true.
    """
    aside = F.pmod(F.xxhash64(F.col(id)), F.lit(CALIBRATION)) == 0
    known = docs.where(learn & F.col(text).isNotNull() & F.col(lang).isNotNull()) \
        .select(F.col(text).alias("text"), F.col(lang).alias("lang"), aside.alias("aside"))
    rows = docs.select(F.struct(*[c for c in docs.columns if c != text]).alias("doc"), F.col(text).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    with Scratch(docs.sparkSession) as tables:
        languages = sorted(r.lang for r in known.select("lang").distinct().collect())
        grams = counts(known, languages, tables)
        model, calibrated = train(grams.where("NOT aside").drop("aside"), languages, tables), None
        if model.languages:
            calibrated = _calibrated(model, known.where("aside"), tables)
        model = train(tables.write(grams.groupBy("lang", "key").agg(F.sum("n").alias("n"))), languages, tables)
        if calibrated:
            model.sharpness, model.limit = calibrated
        return written(_by_tables(rows, model, tables).mapInArrow(
            _score(model), f"doc {kind}, lang_pred string, score double, entropy double, rejected boolean"))


def fold(id: Column, folds: int) -> Column:
    """Checksum of the id's text, modulo ``folds``."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % folds


def op4_langid(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    out = identify(docs, fold(F.col("doc_id"), 4) != 2)
    return out.select(F.col("doc.doc_id").alias("doc_id"), (fold(F.col("doc.doc_id"), 4) == 2).alias("held_out"),
                      "lang_pred", "score", "rejected")
