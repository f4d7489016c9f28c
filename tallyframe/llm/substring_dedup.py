"""Removal of every byte that lies in a repeated string of 200 bytes.

1. A scan of the texts finds runs of strings that share an anchor (``anchors``)
   and sends two hashes per run. Runs whose core is nowhere else hold nothing
   repeated; runs whose whole context is somewhere else are repeated in full.
2. What is left are the edges of passages: cores that are repeated in contexts
   that differ. Their contexts, without the core, are dealt by core, and the
   Burrows-Wheeler transforms of the shards of documents are merged
   (``transforms``): an interval of equal symbols, core and anchor place that
   holds two strings is a repeated string of 200 bytes.

A core with very many different contexts is never brought to one task: its runs
are halved, which lengthens the core, and go through step 1 again.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.joins import null_safe_join
from tallyframe.llm.anchors import LENGTH, REACH, find_runs, flat_bytes, keys_of, pieces
from tallyframe.llm.encoding import by_size
from tallyframe.llm.transforms import SYMBOL, merged_suffixes, read_strings
from tallyframe.staging import stage, stage_side

#: Contexts of a core that are resolved in one task, and contexts in a task together.
GROUP, BUCKET = 3_000, 3_000
SHARDS = 8
#: A core with more than this part of all rows is dealt by core and context.
HOT_SHARE = 2_000
_SLACK = REACH - 1


def _place(anchor, before, after):
    """Anchor, and how far before it the first and the last string of a run begin, in one number."""
    return anchor << 16 | before << 8 | after


def _start(place: Column) -> Column:
    return F.shiftright(place, 16) - F.shiftright(place, 8).bitwiseAND(255)


def _end(place: Column) -> Column:
    return F.shiftright(place, 16) + LENGTH - place.bitwiseAND(255)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text"))


def _joined_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans in the order of their starts, those that overlap joined (two texts' spans may touch)."""
    reach = np.maximum.accumulate(end)
    apart = np.concatenate([[True], start[1:] >= reach[:-1]])
    first = np.flatnonzero(apart)
    return start[first], reach[np.concatenate([first[1:], [len(start)]]) - 1]


def run_keys(keyed: DataFrame) -> DataFrame:
    """``(_id, _hash, place, core, context, n)`` of the runs, and spans ``(_id, _hash, start, end)``.

    Runs that agree within a slice of text are one row with their number ``n``;
    as they are repeated, their spans are sent at once, in rows without a core.
    """
    fields = [T.StructField(c, T.LongType()) for c in ("_hash", "place", "core", "context", "n", "start", "end")]
    schema = T.StructType([keyed.schema["_id"], *fields])
    names = schema.fieldNames()

    def rows(part, text, columns):
        at = pa.array(text)
        n, given = len(text), [part["_id"].take(at), part["_hash"].take(at)]
        return pa.RecordBatch.from_arrays(
            given + [pa.array(columns[c], pa.int64()) if c in columns else pa.nulls(n, pa.int64()) for c in names[2:]],
            names=names,
        )

    def run(batches):
        for batch in batches:
            for part in by_size(batch, "_text"):
                for data, bounds, documents, offsets in pieces(part["_text"]):
                    runs = find_runs(data, bounds)
                    if not len(runs.first):
                        continue
                    core, context = keys_of(data.tobytes(), runs)
                    text = documents[runs.text]
                    moved = offsets[runs.text] - bounds[runs.text]
                    place = _place(runs.anchor + moved, runs.anchor - runs.first, runs.anchor - runs.last)
                    order = np.lexsort([context, core])
                    fresh = np.concatenate(
                        [[True], (core[order][1:] != core[order][:-1]) | (context[order][1:] != context[order][:-1])]
                    )
                    first = np.flatnonzero(fresh)
                    n = np.diff(np.concatenate([first, [len(order)]]))
                    one = order[first]
                    yield rows(part, text[one], {"place": place[one], "core": core[one], "context": context[one], "n": n})
                    # In the order of texts and places; a text's spans never reach into the next.
                    again = np.sort(order[np.repeat(n > 1, n)])
                    if len(again):
                        start, end = _joined_spans(runs.first[again], runs.last[again] + LENGTH)
                        of = np.searchsorted(bounds, start, side="right") - 1
                        yield rows(
                            part, documents[of], {"start": start + (offsets - bounds[:-1])[of], "end": end + (offsets - bounds[:-1])[of]}
                        )

    return keyed.mapInArrow(run, schema)


def classify(runs: DataFrame, label: str) -> DataFrame:
    """Staged ``runs`` whose core is repeated, with ``times`` (of core and context) and ``wanted``.

    ``wanted`` marks what step 2 needs: runs whose context is nowhere else, and one
    of each repeated context of the same cores. One shuffle: rows are dealt by core,
    those of the few hottest cores by core and context. ``runs`` must be written.
    """
    rows = runs.count()
    hot = runs.groupBy("core").count().where(F.col("count") > rows // HOT_SHARE + GROUP)
    # Fewer than HOT_SHARE cores can have so many rows.
    hot = hot.select(F.col("core").alias("_core"), F.lit(True).alias("_hot"))
    marked = runs.join(F.broadcast(hot), F.col("core") == F.col("_core"), "left").drop("_core")
    dealt = marked.withColumn("_deal", F.when(F.col("_hot"), F.xxhash64("core", "context")).otherwise(F.col("core")))
    context = Window.partitionBy("_deal", "core", "context")
    core = Window.partitionBy("_deal", "core")
    # A hot core is repeated, however its rows are dealt; its repeated contexts are always wanted.
    seen = (
        dealt.repartition("_deal")
        .withColumn("times", F.sum("n").over(context))
        .withColumn("_first", F.row_number().over(context.orderBy("n", "place")) == 1)
        .withColumn("_all", F.sum("n").over(core))
        .withColumn("_open", F.max(F.col("times") == 1).over(core))
        .where((F.col("_all") > 1) | F.col("_hot"))
    )
    wanted = (F.col("times") == 1) | (F.col("_first") & (F.col("_open") | F.coalesce("_hot", F.lit(False))))
    kept = seen.withColumn("wanted", wanted).drop("_deal", "_hot", "_first", "_all", "_open")
    return stage(kept, label, compression="zstd")


def _repeated_spans(classified: DataFrame) -> DataFrame:
    whole = classified.where("n = 1 and times > 1")
    return whole.select("_id", "_hash", _start(F.col("place")).alias("start"), _end(F.col("place")).alias("end"))


def _without_core(text: bytes, anchor: int, before: int, after: int) -> bytes:
    """A run's context without the core: what stands before the anchor, and after the core."""
    at = anchor + LENGTH - _SLACK
    return text[anchor - before : anchor] + text[at : at + _SLACK - after]


def contexts_of(keyed: DataFrame, classified: DataFrame) -> DataFrame:
    """The wanted runs with their ``bytes``; ``n`` is how often the context is found at all."""
    wanted = classified.where("wanted").select("_id", "_hash", F.struct("core", "context", "times", "place").alias("_run"))
    # As many as the text has anchors.
    listed = wanted.groupBy("_id", "_hash").agg(F.collect_set("_run").alias("_runs"))
    texts = null_safe_join(keyed, listed, ["_id"], never_null=["_hash"])
    fields = [T.StructField(c, T.LongType()) for c in ("_hash", "place", "core", "context", "n")]
    schema = T.StructType([keyed.schema["_id"], *fields, T.StructField("bytes", T.BinaryType())])

    def run(batches):
        for batch in batches:
            for part in by_size(batch, "_text"):
                listed = part["_runs"]
                number = np.repeat(np.arange(len(listed)), pc.list_value_length(listed).to_numpy())
                flat = listed.flatten()
                place = flat.field("place").to_numpy()
                texts = part["_text"].cast(pa.binary()).to_pylist()
                cut = [
                    _without_core(texts[i], p >> 16, p >> 8 & 255, p & 255)
                    for i, p in zip(number.tolist(), place.tolist(), strict=True)
                ]
                at = pa.array(number)
                numbers = [flat.field(c) for c in ("place", "core", "context", "times")]
                columns = [part["_id"].take(at), part["_hash"].take(at), *numbers, pa.array(cut, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return texts.mapInArrow(run, schema)


def halve(contexts: DataFrame, width: int) -> DataFrame:
    """Runs cut at multiples of ``width`` bytes before the anchor, with the longer core all strings of a part share."""
    names = contexts.columns

    def run(batches):
        for batch in batches:
            table = {c: batch[c].to_pylist() for c in ("place", "core", "n", "bytes")}
            source, out = [], {c: [] for c in ("place", "core", "context", "n", "bytes")}
            for i, (place, core, n, held) in enumerate(zip(*table.values(), strict=True)):
                before, after = place >> 8 & 255, place & 255
                for low in range(after // width * width, before + 1, width):
                    high = min(low + width - 1, _SLACK)
                    first, last = min(before, high), max(after, low)
                    shared = held[before - low : before] + held[before : before + _SLACK - high]
                    part = held[before - first : before + _SLACK - last]
                    seed = xxhash.xxh3_64_intdigest(b"%d %d" % (core, low))
                    source.append(i)
                    out["place"].append(_place(place >> 16, first, last))
                    out["core"].append(_signed(xxhash.xxh3_64_intdigest(shared, seed)))
                    out["context"].append(_signed(xxhash.xxh3_64_intdigest(part, seed ^ (first << 8 | last))))
                    out["n"].append(n)
                    out["bytes"].append(part)
            at = pa.array(source, pa.int64())
            columns = [batch["_id"].take(at), batch["_hash"].take(at)]
            kinds = {"bytes": pa.binary()}
            columns += [pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return contexts.mapInArrow(run, contexts.schema)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def merged_spans(contexts: DataFrame, n_buckets: int) -> DataFrame:
    """``(_id, _hash, start, end)`` of repeated strings in runs whose context is nowhere else.

    Each bucket of cores merges the transforms of its shards of documents.
    """
    fields = [T.StructField(c, T.LongType()) for c in ("_hash", "start", "end")]
    schema = T.StructType([contexts.schema["_id"], *fields])

    def merge(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        data, bounds = flat_bytes(table["bytes"].chunk(0))
        place = table["place"].to_numpy()
        before, after = place >> 8 & 255, place & 255
        core = np.unique(table["core"].to_numpy(), return_inverse=True)[1]
        shard = table["_hash"].to_numpy() % SHARDS
        strings = read_strings(data, bounds)
        suffixes, interval = merged_suffixes(strings, shard, _SLACK // SYMBOL)
        string, at = strings.string[suffixes], strings.place[suffixes]
        # Suffixes that begin a string of the run; equal ones agree in interval, core and place.
        begins = at <= (before - after)[string]
        string, at, interval = string[begins], at[begins], interval[begins]
        offset = before[string] - at
        cores = int(core.max()) + 1
        _, of, times = np.unique(
            (interval * cores + core[string]) * REACH + offset, return_inverse=True, return_counts=True
        )
        found = (times[of] > 1) & (table["n"].to_numpy()[string] == 1)
        string, offset = string[found], offset[found]
        order = np.lexsort([-offset, string])
        string, start = string[order], (place[string] >> 16)[order] - offset[order]
        fresh = np.concatenate([[True], (string[1:] != string[:-1]) | (start[1:] != start[:-1] + 1)])[: len(string)]
        first = np.flatnonzero(fresh)
        last = np.concatenate([first[1:], [len(string)]])[: len(first)] - 1
        rows = pa.array(string[first])
        columns = [table["_id"].take(rows), table["_hash"].take(rows), pa.array(start[first]), pa.array(start[last] + LENGTH)]
        return pa.Table.from_arrays(columns, schema=pa.schema([(n, c.type) for n, c in zip(schema.fieldNames(), columns)]))

    bucket = F.pmod(F.xxhash64("core"), F.lit(n_buckets))
    return contexts.withColumn("_bucket", bucket).groupBy("_bucket").applyInArrow(merge, schema)


def repeated_spans(keyed: DataFrame) -> DataFrame:
    """``(_id, _hash, start, end)``: spans of bytes that cover all repeated strings and nothing else."""
    keys = stage(run_keys(keyed), "runs", compression="zstd")
    spans = [keys.where("core is null").select("_id", "_hash", "start", "end")]
    classified = classify(keys.where("core is not null").select("_id", "_hash", "place", "core", "context", "n"), "repeated-runs")
    spans.append(_repeated_spans(classified))
    contexts = stage(contexts_of(keyed, classified), "contexts", compression="zstd")
    ready, width = [], REACH // 2
    while True:
        large = contexts.groupBy("core").count().where(F.col("count") > GROUP).select(F.col("core").alias("_core"))
        large = stage_side(large, "large-cores")
        if large.isEmpty():
            ready.append(contexts)
            break
        ready.append(contexts.join(large, contexts["core"] == large["_core"], "left_anti"))
        parts = halve(contexts.join(large, contexts["core"] == large["_core"], "left_semi"), width)
        classified = classify(stage(parts, "halves", compression="zstd"), "repeated-halves")
        spans.append(_repeated_spans(classified))
        contexts = classified.where("wanted").withColumn("n", F.col("times")).select(contexts.columns)
        width //= 2
    contexts = reduce(DataFrame.unionByName, ready)
    n_buckets = contexts.count() // BUCKET + 1
    spans.append(merged_spans(contexts, n_buckets))
    return reduce(DataFrame.unionByName, spans)


def remove_repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_bytes, removed, kept)`` of every row: what is left of its text without repeated strings.

    A byte goes if it lies in a string of 200 bytes that also starts anywhere
    else, in the same text or another; strings may overlap and are judged on the
    texts as given. ``removed`` lists ``(start, end)`` in bytes, ascending and
    apart; ``kept`` holds the bytes between (a cut may fall inside a character).

    A null text counts as empty; texts below 200 bytes stay whole. Repeated rows
    are texts of their own, hence repeated in full. Null ids are ordinary; other
    columns are left out; an empty table gives no rows. Hashes that decide are
    128 bits together (core and context). Runs jobs; keys, contexts and spans are
    staged, texts are not.
    """
    keyed = _keyed(docs, id_col, text_col)
    spans = repeated_spans(keyed).groupBy("_id", "_hash").agg(F.collect_set(F.struct("start", "end")).alias("_spans"))
    found = stage(spans, "repeated-spans", compression="zstd")
    joined = null_safe_join(keyed, found, ["_id"], "left", never_null=["_hash"]).select("_id", "_text", "_spans")
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("removed", span),
            T.StructField("kept", T.BinaryType()),
        ]
    )
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches):
        for batch in batches:
            for part in by_size(batch, "_text"):
                texts = part["_text"].cast(pa.binary()).to_pylist()
                removed, kept = [], []
                for text, listed in zip(texts, part["_spans"].to_pylist(), strict=True):
                    places = sorted((s["start"], s["end"]) for s in listed or ())
                    at, left, gone = 0, [], []
                    for start, end in places:
                        if gone and start <= gone[-1]["end"]:
                            gone[-1]["end"] = max(gone[-1]["end"], end)
                        else:
                            gone.append({"start": start, "end": end})
                    for run in gone:
                        left.append(text[at : run["start"]])
                        at = run["end"]
                    removed.append(gone)
                    kept.append(b"".join([*left, text[at:]]))
                sizes = pa.array([len(t) for t in texts], pa.int64())
                columns = [part["_id"], sizes, pa.array(removed, kind), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return joined.mapInArrow(cut, schema)
