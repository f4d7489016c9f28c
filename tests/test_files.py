import gzip
from pathlib import Path

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import __spark_entry__
from tallyframe import tune
from tallyframe.operators import latency, relevance, series
from tallyframe.plans import files as plans
from tallyframe.session import stay_in_place
from tallyframe.sinks import files as sinks
from tallyframe.sources import corpus, images, listing
from tallyframe.staging import shared_dir, stage


@pytest.fixture
def folder(tmp_path):
    for name, content in {
        "doc1": "The cat, the CAT!\n",
        "doc2": 'a cat 3d\n(4x "dog" -x\n',
        "doc10": "cat 12 ...",
        "my notes+1%.txt": "a b",
        "_hidden": "x",
    }.items():
        (tmp_path / name).write_text(content)
    (tmp_path / "empty").write_text("")
    return str(tmp_path)


def test_whole_files(spark, folder):
    docs = {r["doc_id"]: r["text"] for r in corpus.read_corpus(spark, folder).collect()}
    assert set(docs) == {"doc1", "doc2", "doc10", "my notes+1%.txt", "empty"}
    assert docs["doc1"] == "The cat, the CAT!\n"
    assert docs["empty"] == ""
    assert corpus.document_names(spark, folder).count() == 5
    numbered = corpus.read_corpus(spark, folder, name_pattern="^doc[0-9]+$")
    assert {r["doc_id"] for r in numbered.collect()} == {"doc1", "doc2", "doc10"}


def test_lines_score_like_files(spark, folder):
    pattern = "^doc[0-9]+$"
    whole = relevance.tficf(corpus.read_corpus(spark, folder, pattern))
    lines = relevance.tficf_lines(corpus.read_corpus_lines(spark, folder, pattern))
    got = {(r["doc_id"], r["word"]): r["tficf"] for r in lines.collect()}
    assert got == pytest.approx({(r["doc_id"], r["word"]): r["tficf"] for r in whole.collect()})


def test_several_corpora(spark, folder):
    both = corpus.read_corpora(spark, {"0": folder, "1": folder})
    assert relevance.corpus_size(both, "corpus_id").where("n_docs = 5").count() == 2
    assert corpus.read_corpora(spark, {"0": folder}, lines=True).count() == 5
    lines = corpus.read_corpus_lines(spark, folder)
    n = corpus.document_names(spark, folder).count()
    scores = relevance.tficf_lines(lines, n_docs=n).collect()
    whole = relevance.tficf(corpus.read_corpus(spark, folder)).collect()
    assert sorted(r["tficf"] for r in scores) == pytest.approx(sorted(r["tficf"] for r in whole))


def test_score_sinks(spark, folder, tmp_path, capsys):
    scores = relevance.tficf(corpus.read_corpus(spark, folder, "^doc"))
    sinks.write_scores(scores, f"{tmp_path}/out")
    sinks.write_scores(scores, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == scores.count()
    sinks.write_score_lines(scores, f"{tmp_path}/lines")
    lines = [r["value"] for r in spark.read.text(f"{tmp_path}/lines").collect()]
    assert [line.split("\t")[0] for line in lines] == sorted(
        f"{r['doc_id']}@{r['word']}" for r in scores.collect()
    )
    assert all(len(line.split(".")[1]) == 16 for line in lines)
    sinks.show_scores(scores, 1)
    assert "doc1" in capsys.readouterr().out


def test_the_table_is_joined_with_the_lines_where_it_lies(spark, tmp_path):
    rows = [(i, " ".join(f"w{(i * j) % 97}" for j in range(200))) for i in (*range(30), 4)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    query = __spark_entry__.queries()["score_sinks_roundtrip"]
    joined = query(spark, str(tmp_path))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Bucketed: true" in plan, plan
    got = sorted((r.doc_id, r.word, r.tficf, r.line_tficf) for r in joined.collect())
    scores = relevance.tficf(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    expected = {(r.doc_id, r.word): round(r.tficf, 9) for r in scores}
    assert {(d, w): s for d, w, s, _ in got} == pytest.approx(expected)
    assert all(abs(s - line) < 2e-9 for *_, s, line in got) and len(got) == len(expected)
    assert not spark.catalog.listTables(pattern="bucketed_*")


def test_lines_by_share_are_sorted_over_their_folders(spark, tmp_path):
    rows = [(i, " ".join(f"w{(i * j) % 97}" for j in range(200))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    stay_in_place(spark)
    try:
        scores = relevance.tficf(relevance.with_shares(docs, 10), shares=10)
        for _ in range(2):
            stored = sinks.write_scores(scores, f"{tmp_path}/out", "share", 10)
        for _ in range(2):
            sinks.write_score_lines(stored, f"{tmp_path}/lines", compression="gzip", by="share")
    finally:
        tune(spark)
    folders = sorted((tmp_path / "lines").glob("share=*"), key=lambda p: int(p.name.split("=")[1]))
    files = [sorted(f.glob("part-*.gz")) for f in folders]
    assert len(files) > 5 and all(len(found) == 1 for found in files)
    lines = [line for (file,) in files for line in gzip.open(file, "rt", newline="\n").read().splitlines()]
    assert lines == sorted(lines, key=lambda line: line.split("\t")[0])
    sinks.write_score_lines(relevance.tficf(docs), f"{tmp_path}/moved")
    assert lines == [r["value"] for r in spark.read.text(f"{tmp_path}/moved").orderBy(F.split("value", "\t")[0]).collect()]
    assert stored.count() == spark.read.parquet(f"{tmp_path}/out").count() == len(lines)


def test_series_and_report_sinks(spark, tmp_path):
    grid = series.uniform_grid(spark, 0, 1, 5, F.sin)
    sinks.write_series(series.grid_difference(grid, F.lit(5), F.sin, 0, 1), f"{tmp_path}/fn", ("x", "y", "dy"))
    first = spark.read.text(f"{tmp_path}/fn").orderBy("value").first()["value"]
    assert first == "0.000000 0.000000 0.989616"
    summary = spark.createDataFrame([(32, 20.9, 8.164966)], "size int, mean double, stddev double")
    sinks.write_rtt_report(latency.rtt_report(summary, "size"), f"{tmp_path}/rtt")
    assert spark.read.text(f"{tmp_path}/rtt").first()["value"] == "32 20 8.164966"


def test_image_lists(spark, tmp_path):
    (tmp_path / "coco.data").write_text("# note\nclasses=2\nvalid = list.txt\nnames=c.names\n")
    (tmp_path / "list.txt").write_text("images/a.jpg\nimages/b.png\n\n")
    (tmp_path / "c.names").write_text("person\ntraffic light\n")
    labels = tmp_path / "labels"
    labels.mkdir()
    (labels / "a.txt").write_text("1 0.5 0.5 0.25 0.25\n0 0.1 0.1 0.1 0.1\n")
    config = images.read_data_config(spark, f"{tmp_path}/coco.data")
    assert config == {"classes": "2", "valid": "list.txt", "names": "c.names"}
    listed = images.read_image_index(spark, f"{tmp_path}/{config['valid']}").collect()
    assert [tuple(r) for r in listed] == [("a", "images/a.jpg"), ("b", "images/b.png")]
    names = images.read_class_names(spark, f"{tmp_path}/{config['names']}").collect()
    assert [tuple(r) for r in names] == [(0, "person"), (1, "traffic light")]
    boxes = images.read_targets(spark, str(labels)).orderBy("class_id").collect()
    assert tuple(boxes[1]) == ("a", 1, 0.5, 0.5, 0.25, 0.25)


def test_labelled_table(spark, tmp_path):
    spark.createDataFrame([(1, [0.0, 255.0], 3)], "id int, pixels array<double>, y bigint").write.parquet(
        f"{tmp_path}/t"
    )
    table = images.read_labelled(spark, f"{tmp_path}/t", "pixels", "y")
    assert dict(table.dtypes) == {"id": "int", "features": "array<float>", "label": "int"}


def test_stage_uses_the_shared_folder(spark):
    staged = stage(spark.range(10), "numbers")
    assert staged.inputFiles()[0].removeprefix("file://").startswith(shared_dir(spark).removeprefix("file:"))
    assert staged.count() == 10


def test_empty_files_of_one_name_are_documents_each(spark, tmp_path):
    for folder, content in (("lang=a b", "text\n"), ("lang=b%2Bc", ""), ("lang=d", "")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "doc1").write_text(content)
    rows = sorted((r["doc_id"], r["text"]) for r in corpus.read_corpus(spark, str(tmp_path)).collect())
    assert rows == [("doc1", ""), ("doc1", ""), ("doc1", "text\n")]
    rows = sorted((r["doc_id"], r["text"]) for r in corpus.read_corpus(spark, str(tmp_path), doc_col="lang").collect())
    assert rows == [("a b", "text\n"), ("b+c", ""), ("d", "")]


def test_label_files_join_the_image_list(spark, tmp_path):
    (tmp_path / "labels").mkdir()
    (tmp_path / "labels" / "my img 1.txt").write_text("2 0.5 0.5 0.25 0.5\n\n0 0.25 0.25 0.5 0.5\n")
    (tmp_path / "list").write_text("/data/my img 1.jpg\n")
    targets = images.read_detection_targets(spark, str(tmp_path / "labels"), size=100)
    joined = targets.join(images.read_image_index(spark, str(tmp_path / "list")), "image_id")
    rows = sorted((r.class_id, r.x1, r.y1, r.x2, r.y2) for r in joined.collect())
    assert rows == [(0, 0.0, 0.0, 50.0, 50.0), (2, 37.5, 25.0, 62.5, 75.0)]
    assert joined.select("gt_id").distinct().count() == 2


def test_positions_are_those_of_the_order_on_reading_back(spark, tmp_path):
    rows = [(i * 37 % 500, f"line {i}") for i in range(500)]
    table = spark.createDataFrame(rows, "k long, line string").repartition(5)
    sinks.write_ordered(table, str(tmp_path / "lines"), "k", files=4)
    read = sinks.read_ordered(spark, str(tmp_path / "lines")).orderBy("position").collect()
    assert [tuple(r) for r in read] == [(i + 1, *row) for i, row in enumerate(sorted(rows))]
    assert len({f.name for f in (tmp_path / "lines").glob("part-*")}) > 1


def test_positions_of_rows_that_lie_in_order(spark, tmp_path):
    """Shares of documents follow each other by number; their lines are written where they are."""
    rows = [(i * 37 % 120 - 50, " ".join(f"w{(i * j) % 31}" for j in range(40))) for i in range(120)]
    docs = spark.createDataFrame([*rows, (None, "a w3")], "doc_id bigint, text string").repartition(5)
    stay_in_place(spark)
    try:
        scores = relevance.tficf(relevance.with_shares(docs, 9, as_lines=False), shares=9)
        sinks.write_ordered(scores, f"{tmp_path}/lines", "doc_id", "word", by="share")
    finally:
        tune(spark)
    assert len(list((tmp_path / "lines").glob("share=*"))) > 5
    assert all(len(list(f.glob("part-*"))) == 1 for f in (tmp_path / "lines").glob("share=*"))
    read = sinks.read_ordered(spark, f"{tmp_path}/lines", by="share").orderBy("position").collect()
    expected = relevance.tficf(docs).orderBy("doc_id", "word").collect()
    assert [(r.position, r.doc_id, r.word) for r in read] == [(i, r.doc_id, r.word) for i, r in enumerate(expected, 1)]


def test_files_are_listed_in_tasks(spark, tmp_path, monkeypatch):
    for name, text in {"a/x=1/one.txt": "1", "a/two.txt": "", "b/k=_y/three.txt": "33", "a/_hidden/no.txt": "x", "a/.no": "x", "a/sub/no.txt": "x"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    monkeypatch.setattr(DataFrame, "inputFiles", None)
    paths = [str(tmp_path / "a"), f"file:{tmp_path}/b"]
    listed = listing.list_files(spark, paths).collect()
    found = {(r["root"], r["path"].removeprefix(f"file://{tmp_path}/"), r["size"]) for r in listed}
    assert found == {(paths[0], "a/x=1/one.txt", 1), (paths[0], "a/two.txt", 0), (paths[1], "b/k=_y/three.txt", 2)}
    assert sorted(r["doc_id"] for r in corpus.document_names(spark, paths[0]).collect()) == ["one.txt", "two.txt"]


@pytest.mark.parametrize("lines", [True, False])
def test_corpora_are_one_scan(spark, tmp_path, lines):
    texts = {"en/a.txt": "one\ntwo", "de/b.txt": "eins", "de/old/c.txt": "zwei", "fr/d.txt": "", "en/e f+g.txt": "three"}
    for name, text in texts.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    paths = {c: str(tmp_path / c) for c in ("en", "de", "fr")} | {"old": str(tmp_path / "de" / "old"), "en too": str(tmp_path / "en")}
    read = corpus.read_corpora(spark, paths, lines=lines)
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [value") == 1
    expected = {("en", "a.txt", "one\ntwo"), ("de", "b.txt", "eins"), ("old", "c.txt", "zwei"), ("en", "e f+g.txt", "three")}
    expected |= {("en too", d, t) for c, d, t in expected if c == "en"}
    if lines:
        expected = {(c, d, line) for c, d, t in expected for line in t.split("\n")}
    else:
        expected |= {("fr", "d.txt", "")}
    assert {tuple(r) for r in read.collect()} == expected


def test_a_language_is_written_by_several_tasks(spark, tmp_path):
    rows = [(i, f"word{i} word", "en") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(plans, "fresh_path", lambda spark, label: f"{tmp_path}/{label}")
        spark.conf.set("spark.sql.files.openCostInBytes", "128m")
        try:
            found = plans.read_several_corpora(spark, str(tmp_path)).collect()
        finally:
            spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [tuple(r) for r in found] == [("en", 80, 41)]
    assert len(list((tmp_path / "corpora" / "lang=en").glob("part-*.txt"))) == 4


def test_a_folder_per_document_is_written_and_read_in_tasks(spark, tmp_path, monkeypatch):
    rows = [(1, "a\nb"), (1, "again"), (2, ""), (3, None), (40, "caf\u00e9 \r\n"), (None, "no id")]
    table = spark.createDataFrame(rows, "folder long, text string").repartition(3)
    table.repartition("folder").write.partitionBy("folder").text(f"{tmp_path}/by_spark")
    sinks.write_folders(table, f"{tmp_path}/by_tasks", "folder", "text")
    lines = [sorted((r["folder"], r["value"]) for r in spark.read.text(f"{tmp_path}/{k}").na.fill(-1).collect()) for k in ("by_spark", "by_tasks")]
    assert lines[0] == lines[1]
    (tmp_path / "by_tasks" / "folder=7").mkdir()
    (tmp_path / "by_tasks" / "folder=7" / "empty.txt").write_text("")
    monkeypatch.setattr(type(spark.read), "text", None)  # the driver holds no index of the files
    docs = corpus.read_corpus(spark, f"{tmp_path}/by_tasks", doc_col="folder")
    assert docs.schema["doc_id"].dataType.simpleString() == "int"
    found = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert sorted(found.pop(1).splitlines()) == ["a", "again", "b"]
    assert found == {2: "\n", 3: "\n", 40: "caf\u00e9 \r\n\n", None: "no id\n", 7: ""}
    spark.createDataFrame([(2**40, "x")], "folder long, text string").transform(lambda t: sinks.write_folders(t, f"{tmp_path}/wide", "folder", "text") or t)
    assert corpus.read_corpus(spark, f"{tmp_path}/wide", doc_col="folder").first()["doc_id"] == 2**40


def test_folders_whose_names_a_scan_must_judge_are_scanned(spark, tmp_path):
    for name in ("2024-01-02", "2024-01-03"):
        (tmp_path / "days" / f"day={name}").mkdir(parents=True)
        (tmp_path / "days" / f"day={name}" / "x.txt").write_text("x")
    assert listing.read_small_files(spark, f"{tmp_path}/days", "day") is None
    assert corpus.read_corpus(spark, f"{tmp_path}/days", doc_col="day").schema["doc_id"].dataType.simpleString() == "date"


def test_label_folders_are_read_in_tasks(spark, tmp_path, monkeypatch):
    names = ["img_1", "a b+c=d/e", "50%", "img_2"]
    rows = [(names[i % 4], f"{i} 0.5 0.5 0.25 0.5") for i in range(40)]
    table = spark.createDataFrame(rows, "image string, value string").repartition(3)
    sinks.write_folders(table, f"{tmp_path}/labels", "image", "value")
    monkeypatch.setattr(type(spark.read), "text", None)
    targets = images.read_detection_targets(spark, f"{tmp_path}/labels", 100, name_col="image")
    assert sorted((r["image_id"], r["class_id"]) for r in targets.collect()) == sorted((n, int(v.split()[0])) for n, v in rows)
    assert [r["gt_id"] for r in targets.collect()] == [r["gt_id"] for r in targets.collect()]
    assert targets.select("gt_id").distinct().count() == 40


def test_whole_corpora_are_compressed_files(spark, tmp_path):
    rows = [(i, f"text {i} " + "word " * 500) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(tuple(r) for r in plans.whole_corpora(spark, str(tmp_path)).collect())
    sizes = [sum(len(t) + 1 for i, t in rows if i % 3 == k) for k in range(3)]
    assert found == [*((f"corpus {k}", 2, n) for k, n in enumerate(sizes)), ("corpus 3", 1, 0)]
    folder = max(Path(shared_dir(spark).removeprefix("file:")).glob("whole-corpora-*"), key=lambda p: p.stat().st_mtime)
    written = [f for k in range(3) for f in (folder / f"c{k}").glob("part-*")]
    assert len(written) == 6 and sum(f.stat().st_size for f in written) < sum(sizes) / 10
