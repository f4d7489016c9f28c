"""Term frequency times inverse corpus frequency over document collections.

A corpus is a DataFrame with one row per document: ``doc_id`` and ``text``, and
optionally a corpus column when several collections are scored in one run.

The text is moved once, hashed on the document key, before it is split. Every
token of a document is then in one partition, so counting (document, word)
pairs needs no further shuffle; moving the pairs instead would move several
times the bytes. The number of partitions follows the measured bytes of text, so
that a task counts about ``TASK_BYTES`` of it whatever the size of the corpus. A
score stages its pair counts, with the document's size beside them: a text is
split once, and all that a score needs comes from that table. Counts, scores,
posting lists and per-corpus weights therefore run a job when called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions import scores, text
from tallyframe.functions.joins import null_safe_join
from tallyframe.operators import ordered
from tallyframe.staging import fresh_path, stage, write_bucketed

#: Bytes of text whose (document, word) pairs one task counts.
TASK_BYTES = 8 << 20

#: Column with the share of a document.
SHARE = "share"


def _keys(corpus_col: str | None) -> list[str]:
    return [corpus_col] if corpus_col else []


def _shares(docs: DataFrame) -> int:
    """Partitions of about ``TASK_BYTES`` of text, one per core at least; runs a job."""
    held = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-held // TASK_BYTES))


def _token_arrays(
    docs: DataFrame,
    mode: str,
    corpus_col: str | None = None,
    keep_leading_empty: bool = False,
) -> DataFrame:
    """One row per document with its token array in ``tokens``.

    The array is wrapped and exploded once: a generator output is a plain
    attribute, so the size and the words below do not evaluate the tokenizer
    again.
    """
    keys = [*_keys(corpus_col), "doc_id"]
    return (
        docs.select(*keys, "text")
        .repartition(_shares(docs), *keys)
        .select(
            *keys,
            F.explode(F.array(text.tokens("text", mode, keep_leading_empty))).alias("tokens"),
        )
    )


def _spread(docs: DataFrame) -> DataFrame:
    """The rows over all cores when the scan has fewer splits than cores.

    Tokenizing is bound by the processor; a large input has more splits than
    cores and is left where it is.
    """
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return docs.repartition(cores, "doc_id") if docs.rdd.getNumPartitions() < cores else docs


def token_rows(docs: DataFrame, mode: str = "legal", keep_leading_empty: bool = False) -> DataFrame:
    """``(doc_id, word)``, one row per token."""
    return _spread(docs.select("doc_id", "text")).select(
        "doc_id", F.explode(text.tokens("text", mode, keep_leading_empty)).alias("word")
    )


def legal_words(docs: DataFrame) -> DataFrame:
    return token_rows(docs, "legal")


def _counts(arrays: DataFrame, corpus_col: str | None) -> DataFrame:
    keys = [*_keys(corpus_col), "doc_id"]
    return (
        arrays.select(*keys, F.size("tokens").cast("bigint").alias("ds"), F.explode("tokens").alias("word"))
        .groupBy(*keys, "ds", "word")
        .agg(F.count(F.lit(1)).alias("wc"))
    )


def _staged_counts(
    docs: DataFrame, mode: str, corpus_col: str | None = None, keep_leading_empty: bool = False
) -> DataFrame:
    """``(doc_id, ds, word, wc)``, written once; the only place where a score splits its texts."""
    return stage(_counts(_token_arrays(docs, mode, corpus_col, keep_leading_empty), corpus_col), "word-counts")


def _pair_frequencies(counts: DataFrame, corpus_col: str | None) -> DataFrame:
    return counts.groupBy(*_keys(corpus_col), "word").agg(F.count(F.lit(1)).alias("df"))


def _frequencies(arrays: DataFrame, corpus_col: str | None) -> DataFrame:
    keys = _keys(corpus_col)
    return (
        arrays.select(*keys, F.explode(F.array_distinct("tokens")).alias("word"))
        .groupBy(*keys, "word")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def word_counts(docs: DataFrame, mode: str = "legal", corpus_col: str | None = None) -> DataFrame:
    """``(doc_id, word, wc)``: occurrences of each word in each document."""
    return _counts(_token_arrays(docs, mode, corpus_col), corpus_col).drop("ds")


def doc_sizes(docs: DataFrame, mode: str = "legal") -> DataFrame:
    """``(doc_id, ds)``: tokens per document that has any."""
    size = F.size(text.tokens("text", mode)).cast("bigint")
    return _spread(docs.select("doc_id", "text")).select("doc_id", size.alias("ds")).where("ds > 0")


def doc_frequency(docs: DataFrame, mode: str = "legal", corpus_col: str | None = None) -> DataFrame:
    """``(word, df)``: documents that hold the word, each counted once."""
    source = _spread(docs.select(*_keys(corpus_col), "doc_id", "text"))
    arrays = source.select(
        *_keys(corpus_col), F.explode(F.array(text.tokens("text", mode))).alias("tokens")
    )
    return _frequencies(arrays, corpus_col)


def corpus_size(docs: DataFrame, corpus_col: str | None = None) -> DataFrame:
    """Number of documents, with or without words."""
    return docs.groupBy(*_keys(corpus_col)).agg(F.count(F.lit(1)).alias("n_docs"))


def vocabulary(docs: DataFrame, mode: str = "legal") -> DataFrame:
    return doc_frequency(docs, mode).select("word")


def vocabulary_size(docs: DataFrame, mode: str = "legal") -> DataFrame:
    return vocabulary(docs, mode).agg(F.count(F.lit(1)).alias("n_words"))


def postings(docs: DataFrame, mode: str = "legal", segment_docs: int = 4096) -> DataFrame:
    """``(word, df, segment, docs)``: sorted documents per word.

    A frequent word would put its whole list into one task and one row, so a
    list is cut into ``ceil(df / segment_docs)`` segments by a document hash.
    The segments of a word together hold every document exactly once. Their
    number is part of the result: it follows ``segment_docs``.
    """
    counts = _staged_counts(docs, mode)
    pairs = counts.select("doc_id", document_hash("doc_id").alias("_hash"), "word")
    segments = F.ceil(F.col("df") / F.lit(segment_docs))
    return (
        pairs.join(_pair_frequencies(counts, None), "word")
        .withColumn("segment", F.col("_hash") % segments)
        .repartition("word", "segment")
        .groupBy("word", "df", "segment")
        .agg(F.array_sort(F.collect_list("doc_id")).alias("docs"))
    )


def document_hash(column: str) -> Column:
    """32 bits of md5 as a bigint, the same value in every engine."""
    digest = F.md5(F.col(column).cast("string"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def score_shares(docs: DataFrame) -> int:
    """Shares of documents that ``tficf`` counts by; a few per core, as hashing leaves some partitions empty."""
    return max(4 * docs.sparkSession.sparkContext.defaultParallelism, _shares(docs))


def with_shares(docs: DataFrame, shares: int, as_lines: bool = True) -> DataFrame:
    """Add ``share``: about ``shares`` runs of documents, numbered in the order of their lines; runs jobs.

    Lines begin with the document as text and ``@``. Without ``as_lines`` the
    order is that of the documents themselves.
    """
    name = F.concat(F.col("doc_id").cast("string"), F.lit("@")) if as_lines else F.col("doc_id")
    keyed = docs.withColumn("_key", name)
    cut = ordered.with_blocks(keyed, [], ["_key"], min_rows=1, max_blocks=shares)
    return cut.select(*docs.columns, F.col(ordered.BLOCK).alias(SHARE))


def _share_counts(
    docs: DataFrame, mode: str, corpus_col: str | None, keep_leading_empty: bool, shares: int
) -> DataFrame:
    """``(share, doc_id, ds, word, wc)``, written once in files by share."""
    keys = [SHARE, *_keys(corpus_col), "doc_id"]
    arrays = docs.select(*keys, "text").repartition(shares, SHARE).select(
        *keys, F.explode(F.array(text.tokens("text", mode, keep_leading_empty))).alias("tokens")
    )
    pairs = arrays.select(*keys, F.size("tokens").cast("bigint").alias("ds"), F.explode("tokens").alias("word"))
    counts = pairs.groupBy(*keys, "ds", "word").agg(F.count(F.lit(1)).alias("wc"))
    path = fresh_path(docs.sparkSession, "word-counts")
    return write_bucketed(counts, path, shares, SHARE, compression="zstd")


def _share_frequencies(counts: DataFrame, corpus_col: str | None) -> DataFrame:
    """``(share, word, df)``: the documents of all shares that hold a word, beside each share that has it."""
    keys = [*_keys(corpus_col), "word"]
    held = counts.groupBy(SHARE, *keys).agg(F.count(F.lit(1)).alias("held"))
    return held.select(SHARE, *keys, F.sum("held").over(Window.partitionBy(*keys)).alias("df"))


def _weights(frequencies: DataFrame, docs: DataFrame, corpus_col: str | None, *more: str) -> DataFrame:
    """Inverse corpus frequency per row of ``frequencies``: per word or per word of a share, not per pair."""
    if corpus_col is None:
        n = corpus_size(docs).select("n_docs").scalar()
        return frequencies.select(*more, "word", scores.icf(n, F.col("df")).alias("icf"))
    return null_safe_join(frequencies, corpus_size(docs, corpus_col), [corpus_col]).select(
        *more, corpus_col, "word", scores.icf(F.col("n_docs"), F.col("df")).alias("icf")
    )


def term_frequency(docs: DataFrame, mode: str = "legal", corpus_col: str | None = None) -> DataFrame:
    counts = _counts(_token_arrays(docs, mode, corpus_col), corpus_col)
    return counts.select(
        *_keys(corpus_col), "doc_id", "word", scores.tf(F.col("wc"), F.col("ds")).alias("tf")
    )


def inverse_corpus_frequency(
    docs: DataFrame, mode: str = "legal", corpus_col: str | None = None
) -> DataFrame:
    return _weights(doc_frequency(docs, mode, corpus_col), docs, corpus_col)


def tficf(
    docs: DataFrame,
    mode: str = "legal",
    corpus_col: str | None = None,
    keep_leading_empty: bool = False,
    shares: int | None = None,
) -> DataFrame:
    """``(doc_id, word, tficf)`` for a corpus with one row per document.

    Words of every document score 0 and stay in the result. The join on the
    word is skewed by frequent words; its small side has one row per word, so
    adaptive execution can split the large side freely.

    With ``shares``, the number given to ``with_shares``, pairs stay in their
    share instead, and each share is sent the weights of the words it has: on a
    session that keeps rows in place (``session.stay_in_place``) no pair is
    moved. The result then has ``share`` in front and lies by it.
    """
    keys = _keys(corpus_col)
    if shares:
        counts = _share_counts(docs, mode, corpus_col, keep_leading_empty, shares)
        found = _weights(_share_frequencies(counts, corpus_col), docs, corpus_col, SHARE)
        weights, plain, front = found.repartition(shares, SHARE), [SHARE, "word"], [SHARE, *keys]
    else:
        counts, plain, front = _staged_counts(docs, mode, corpus_col, keep_leading_empty), ["word"], keys
        weights = _weights(_pair_frequencies(counts, corpus_col), docs, corpus_col)
    return null_safe_join(counts, weights, keys, never_null=plain).select(
        *front,
        "doc_id",
        "word",
        (scores.tf(F.col("wc"), F.col("ds")) * F.col("icf")).alias("tficf"),
    )


def tficf_sorted(docs: DataFrame, mode: str = "legal") -> DataFrame:
    """Scores in document and word order: a range shuffle, many sorted parts."""
    return tficf(docs, mode).orderBy("doc_id", "word")


def tficf_via_union(docs: DataFrame, mode: str = "legal", shares: int | None = None) -> DataFrame:
    """The same score as a union of TF rows and ICF rows, multiplied per pair.

    With ``shares``, as in ``tficf``, no pair is moved: both rows of a pair lie in
    its share. The result then has ``share`` in front and lies by it.
    """
    if shares:
        counts = _share_counts(docs, mode, None, False, shares)
        found = _weights(_share_frequencies(counts, None), docs, None, SHARE)
        # A union lies as its sides do, once the column has a name that no table gave it.
        weights, plain, front = found.repartition(shares, SHARE), [SHARE, "word"], [F.col(SHARE).alias("_lies")]
    else:
        counts, plain, front = _staged_counts(docs, mode), ["word"], []
        weights = _weights(_pair_frequencies(counts, None), docs, None)
    tf_rows = counts.select(*front, "doc_id", "word", scores.tf(F.col("wc"), F.col("ds")).alias("factor"))
    # Every word has a weight; a left join lies as its left side alone.
    icf_rows = counts.join(weights, plain, "left").select(*front, "doc_id", "word", F.col("icf").alias("factor"))
    both = tf_rows.unionByName(icf_rows)
    if shares:
        products = both.groupBy("_lies", "doc_id", "word").agg(F.product("factor").alias("tficf"))
        return products.withColumnRenamed("_lies", SHARE)
    # Two rows of each pair, which no partial sum makes fewer.
    both = both.repartition(2 * _shares(docs), "doc_id", "word")
    return both.groupBy("doc_id", "word").agg(F.product("factor").alias("tficf"))


def tf_icf_join(docs: DataFrame, mode: str = "legal") -> DataFrame:
    """TF and ICF as separate per-pair frames, joined on document and word."""
    counts = _staged_counts(docs, mode)
    weights = _weights(_pair_frequencies(counts, None), docs, None)
    tf_rows = counts.select("doc_id", "word", scores.tf(F.col("wc"), F.col("ds")).alias("tf"))
    icf_rows = counts.select("doc_id", "word").join(weights, "word")
    return null_safe_join(tf_rows, icf_rows, ["doc_id"], never_null=["word"]).select(
        "doc_id", "word", "tf", "icf", (F.col("tf") * F.col("icf")).alias("tficf")
    )


def line_word_counts(lines: DataFrame, mode: str = "legal") -> DataFrame:
    """``(doc_id, word, wc)`` when a document is spread over many rows.

    Partial aggregation runs before the shuffle, so one document that holds a
    large share of all lines costs each task one row per distinct word.
    """
    return token_rows(lines, mode).groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("wc"))


def tficf_lines(lines: DataFrame, mode: str = "legal", n_docs: int | None = None) -> DataFrame:
    """Scores for a corpus of lines; no document has to fit into one row.

    ``n_docs`` is the number of documents including empty ones, which have no
    line; by default the documents with at least one line are counted.
    """
    counts = stage(line_word_counts(lines, mode), "word-counts")
    if n_docs is None:
        n = lines.agg(F.count_distinct("doc_id").alias("n_docs")).scalar()
    else:
        n = F.lit(n_docs)
    return tficf_from_counts(counts, n)


def tficf_from_counts(counts: DataFrame, n: Column) -> DataFrame:
    """Scores from ``(doc_id, word, wc)``, which is read three times: stage it first."""
    sizes = counts.groupBy("doc_id").agg(F.sum("wc").alias("ds"))
    frequencies = counts.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    weights = frequencies.select("word", scores.icf(n, F.col("df")).alias("icf"))
    return (
        null_safe_join(counts, sizes, ["doc_id"])
        .join(weights, "word")
        .select(
            "doc_id",
            "word",
            (scores.tf(F.col("wc"), F.col("ds")) * F.col("icf")).alias("tficf"),
        )
    )
