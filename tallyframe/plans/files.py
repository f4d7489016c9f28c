"""Tables written in the file formats that the readers take, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import detection, relevance
from tallyframe.plans.detections import _PAIRS
from tallyframe.plans.tables import documents, events, labelled, load
from tallyframe.sinks import files as sinks
from tallyframe.sources import corpus, images
from tallyframe.staging import fresh_path, stage


def read_several_corpora(spark, sf):
    """One folder of text lines per language, read as corpora: lines and words of each."""
    path = fresh_path(spark, "corpora")
    docs = documents(spark, sf, "lang")
    docs.select("lang", "text").write.partitionBy("lang").text(path)
    # A language is a folder; there are as many paths to name as languages.
    langs = [r["lang"] for r in docs.select("lang").distinct().orderBy("lang").collect()]
    lines = corpus.read_corpora(spark, {lang: f"{path}/lang={lang}" for lang in langs}, lines=True)
    words = lines.select(F.col("corpus_id").alias("doc_id"), "text")
    return (
        relevance.token_rows(words, "raw")
        .groupBy(F.col("doc_id").alias("corpus_id"))
        .agg(F.count(F.lit(1)).alias("n_words"), F.count_distinct("word").alias("n_distinct"))
    )


def image_index_file(spark, sf):
    """A list of image files, one line per event."""
    path = fresh_path(spark, "image-list")
    line = F.format_string("/data/set %d/img+%d.v2.jpg", "user_id", "event_id")
    events(spark, sf).select(F.concat(F.lit("  "), line, F.lit(" "))).write.text(path)
    return images.read_image_index(spark, path)


def labelled_table(spark, sf):
    """A feature table under other column names, read as features and label."""
    path = fresh_path(spark, "labelled")
    labelled(spark, sf).select(
        "vec_id", F.col("features").alias("pixels"), F.col("label").cast("string").alias("class")
    ).write.parquet(path)
    read = images.read_labelled(spark, path, "pixels", "class")
    ends = (F.element_at("features", 1).alias("first"), F.element_at("features", -1).alias("last"))
    return read.select("vec_id", "label", F.size("features").cast("bigint").alias("width"), *ends)


def class_names_file(spark, sf):
    """A file of class names, numbered by line."""
    path = fresh_path(spark, "class-names")
    names = events(spark, sf).select("event_type").distinct()
    lines = names.agg(F.array_join(F.array_sort(F.collect_list("event_type")), "\n").alias("value"))
    lines.coalesce(1).write.text(path)
    read = images.read_class_names(spark, path)
    return read.select(F.col("class_id").cast("bigint").alias("class_id"), "class_name")


def document_files(spark, sf):
    """Documents named by their files: one folder per source, a file each, told apart by its folder."""
    path = fresh_path(spark, "sources")
    load(spark, sf, "documents").select("source", "text").repartition("source").write.partitionBy("source").text(path)
    lines = spark.read.text(path).select("source", corpus.file_name().alias("doc_id"))
    named = F.regexp_extract("doc_id", r"^(part)-\d+-.*(\.txt)$", 1), F.regexp_extract("doc_id", r"^(part)-\d+-.*(\.txt)$", 2)
    # One task writes the file of a source; its number and the write's id differ from run to run.
    per_file = lines.groupBy("source", "doc_id").agg(F.count(F.lit(1)).alias("n_lines"))
    return per_file.select("source", F.concat(*named).alias("name"), "n_lines")


def whole_corpora(spark, sf):
    """Four folders of whole files, one of a file without content, read in one scan.

    A file holds a sixth of all text, so files are compressed."""
    path = fresh_path(spark, "whole-corpora")
    docs = documents(spark, sf)
    for number in range(3):
        part = docs.where(F.col("doc_id") % 3 == number).select("doc_id", F.regexp_replace("text", "[\\r\\n]", " ").alias("text"))
        part.repartition(2, "doc_id").sortWithinPartitions("doc_id").select("text").write.text(f"{path}/c{number}", compression="gzip")
    spark.range(0, 0, 1, 1).select(F.col("id").cast("string")).write.text(f"{path}/c3")
    read = corpus.read_corpora(spark, {f"corpus {i}": f"{path}/c{i}" for i in range(4)})
    sizes = F.sum(F.length("text")).cast("bigint").alias("n_chars")
    return read.groupBy("corpus_id").agg(F.count(F.lit(1)).alias("n_docs"), sizes)


def label_files(spark, sf):
    """Targets written as label files in shares of an image's size, read back and matched."""
    path = fresh_path(spark, "labels")
    boxes = events(spark, sf).where("event_id % 3 = 0").select(
        F.format_string("img_%d", "user_id").alias("image"),
        F.format_string("%d %.6f %.6f %.6f %.6f", F.col("event_id") % 5, *_label_numbers()).alias("value"),
    )
    sinks.write_folders(boxes, path, "image", "value")
    targets = images.read_detection_targets(spark, path, 416, name_col="image")
    det = events(spark, sf).select(
        F.format_string("img_%d", "user_id").alias("image_id"),
        F.col("event_id").alias("det_id"),
        (F.col("event_id") % 5).cast("int").alias("class_id"),
        F.col("value").alias("score"),
        *_label_corners(),
    )
    # Ids of targets are numbers of this reading: the claims are compared by detection alone.
    matched = detection.match_detections(det, stage(targets, "label-targets"))
    return matched.select("class_id", "det_id", F.col("tp").cast("bigint").alias("tp"))


def _label_numbers():
    """Centre and size of a box in shares of the image, all multiples of 1 / 1,600 and so exact in six decimals."""
    i = F.col("event_id")
    return [(400 + i * 37 % 800) / 1600.0, (400 + i * 53 % 800) / 1600.0, (160 + i % 11 * 16) / 1600.0, (160 + i % 13 * 16) / 1600.0]


def _label_corners():
    x, y, w, h = _label_numbers()
    shift = (F.col("event_id") % 7) * 2.0
    return [((x - w / 2) * 416 + shift).alias("x1"), ((y - h / 2) * 416).alias("y1"), ((x + w / 2) * 416 + shift).alias("x2"), ((y + h / 2) * 416).alias("y2")]


QUERIES = {
    "read_several_corpora": read_several_corpora,
    "image_index_file": image_index_file,
    "labelled_table": labelled_table,
    "class_names_file": class_names_file,
    "document_files": document_files,
    "whole_corpora": whole_corpora,
    "label_files": label_files,
}

ORACLES = {
    "read_several_corpora": """with w as (select lang, unnest(regexp_split_to_array(text, '\\s+')) word from documents)
select lang corpus_id, count(*) n_words, count(distinct word) n_distinct from w where word <> '' group by lang""",
    "image_index_file": """select 'img+' || event_id || '.v2' image_id,
  '/data/set ' || user_id || '/img+' || event_id || '.v2.jpg' as path from events""",
    "labelled_table": """select vec_id, label, len(embedding)::bigint width, embedding[1] as "first",
  embedding[len(embedding)] as "last" from embeddings""",
    "class_names_file": """select row_number() over (order by event_type) - 1 class_id, event_type class_name
from (select distinct event_type from events)""",
    "document_files": """select source, 'part.txt' as "name", sum(len(string_split(text, chr(10))))::bigint n_lines
from documents group by source""",
    "whole_corpora": """with d as (select doc_id % 3 c, hash(doc_id) h, length(text) + 1 n from documents)
select 'corpus ' || c corpus_id, 2::bigint n_docs, sum(n)::bigint n_chars from d group by c
union all select 'corpus 3', 1, 0""",
    "label_files": """with base as (select event_id det_id, user_id img, (event_id % 5)::int cls, value score,
  (400 + event_id * 37 % 800) / 1600.0::double x, (400 + event_id * 53 % 800) / 1600.0::double y,
  (160 + event_id % 11 * 16) / 1600.0::double w, (160 + event_id % 13 * 16) / 1600.0::double h,
  (event_id % 7) * 2.0::double d from events),
pred as (select det_id, img, cls, score, (x - w / 2) * 416 + d x1, (y - h / 2) * 416 y1,
  (x + w / 2) * 416 + d x2, (y + h / 2) * 416 y2 from base),
gt as (select det_id gid, img, cls, (x - w / 2) * 416 gx1, (y - h / 2) * 416 gy1,
  (x + w / 2) * 416 gx2, (y + h / 2) * 416 gy2 from base where det_id % 3 = 0)"""
    + _PAIRS + " select cls class_id, det_id, tp from lab",
}
