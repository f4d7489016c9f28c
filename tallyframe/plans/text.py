"""Queries over the documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.text import raw_tokens, score_line, score_line_fields
from tallyframe.operators import relevance
from tallyframe.plans.tables import documents
from tallyframe.session import stay_in_place
from tallyframe.sinks import files as sinks
from tallyframe.sources import corpus as sources
from tallyframe.staging import fresh_path

_LEGAL = r"""
tok0 as (select doc_id, {extra} unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) w from documents),
tok1 as (select doc_id, {extra} regexp_replace(w, '["''()\[\],!.`:?&*=¡ª;{{}}]', '', 'g') w
         from tok0 where w <> '' and not regexp_matches(w, '^\p{{Nd}}')),
tok as (select doc_id, {extra} lower(w) word from tok1
        where w <> '' and not regexp_matches(w, '^(\p{{Nd}}|-|¿)'))"""
_LEGAL_TOK = _LEGAL.format(extra="")
_RAW_TOK = r"""
tok as (select doc_id, w word from
        (select doc_id, unnest(regexp_split_to_array(text, '\s+')) w from documents) where w <> '')"""
_PARTS = """,
wc as (select doc_id, word, count(*) wc from tok group by doc_id, word),
ds as (select doc_id, sum(wc)::bigint ds from wc group by doc_id),
dfr as (select word, count(*) df from wc group by word),
n as (select count(*) n from documents),
tf as (select wc.doc_id, wc.word, log10(wc.wc::double / ds.ds + 1.0) tf from wc join ds using (doc_id)),
icf as (select word, log10((n.n + 1)::double / (dfr.df + 1)) icf from dfr, n),
score as (select doc_id, word, tf, icf, tf * icf s from tf join icf using (word))
"""
_LEGAL_CTE = "with " + _LEGAL_TOK + _PARTS
_RAW_CTE = "with " + _RAW_TOK + _PARTS
_SCORE = "select doc_id, word, round(s, 9) tficf from score"


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("tficf", F.round("tficf", 9))


def tficf_legal(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(relevance.tficf(documents(spark, sf), "legal"))


def tficf_raw(spark, sf):
    return _rounded(relevance.tficf(documents(spark, sf), "raw"))


def tficf_by_corpus(spark, sf):
    return _rounded(relevance.tficf(documents(spark, sf, "lang"), "legal", corpus_col="lang"))


def tficf_via_union(spark, sf):
    stay_in_place(spark)
    docs = documents(spark, sf)
    shares = relevance.score_shares(docs)
    dealt = relevance.with_shares(docs, shares)
    return _rounded(relevance.tficf_via_union(dealt, shares=shares)).drop(relevance.SHARE)


def tficf_sorted(spark, sf):
    return _rounded(relevance.tficf_sorted(documents(spark, sf)))


def tf_icf_join(spark, sf):
    joined = relevance.tf_icf_join(documents(spark, sf))
    return joined.select(
        "doc_id", "word", *[F.round(c, 9).alias(c) for c in ("tf", "icf", "tficf")]
    )


def word_count_legal(spark, sf):
    return relevance.word_counts(documents(spark, sf), "legal")


def word_count_raw(spark, sf):
    return relevance.word_counts(documents(spark, sf), "raw")


def doc_size_legal(spark, sf):
    return relevance.doc_sizes(documents(spark, sf), "legal")


def doc_size_raw(spark, sf):
    return relevance.doc_sizes(documents(spark, sf), "raw")


def doc_frequency(spark, sf):
    return relevance.doc_frequency(documents(spark, sf))


def corpus_size(spark, sf):
    return relevance.corpus_size(documents(spark, sf))


def vocabulary(spark, sf):
    return relevance.vocabulary(documents(spark, sf))


def vocabulary_size(spark, sf):
    return relevance.vocabulary_size(documents(spark, sf))


def postings(spark, sf):
    segments = relevance.postings(documents(spark, sf), segment_docs=256)
    listed = F.array_join(F.col("docs").cast("array<string>"), ",")
    return segments.select("word", "df", "segment", listed.alias("docs"))


def term_frequency(spark, sf):
    return relevance.term_frequency(documents(spark, sf)).withColumn("tf", F.round("tf", 9))


def inverse_corpus_frequency(spark, sf):
    return relevance.inverse_corpus_frequency(documents(spark, sf)).withColumn(
        "icf", F.round("icf", 9)
    )


def score_lines(spark, sf):
    scores = relevance.tficf(documents(spark, sf))
    return scores.select(score_line("doc_id", "word", "tficf", decimals=6).alias("line"))


def raw_token_rows(spark, sf):
    return relevance.token_rows(documents(spark, sf), "raw")


def raw_tokens_leading_empty(spark, sf):
    padded = F.concat(F.lit(" "), "text", F.lit(" \n"))
    return documents(spark, sf).select(
        "doc_id", F.explode(raw_tokens(padded, keep_leading_empty=True)).alias("word")
    )


def legal_words(spark, sf):
    return relevance.legal_words(documents(spark, sf))


def corpus_files_roundtrip(spark, sf):
    """Documents written as one folder of text files per source and read back as lines."""
    path = fresh_path(spark, "corpus")
    documents(spark, sf, "source").select("source", "text").write.partitionBy("source").text(path)
    lines = sources.read_corpus_lines(spark, path, doc_col="source", name_pattern="^src[0-9]+$")
    return relevance.line_word_counts(lines)


def corpus_whole_files(spark, sf):
    """Documents as whole files, one folder each, and two empty files."""
    path = fresh_path(spark, "whole-files")
    docs = documents(spark, sf).select(F.col("doc_id").alias("folder"), "text")
    sinks.write_folders(docs, path, "folder", "text")
    for empty in (-1, -2):
        spark.range(0, 0, 1, 1).select(F.col("id").cast("string")).write.text(f"{path}/folder={empty}")
    read = sources.read_corpus(spark, path, doc_col="folder")
    # The writer ends a record with a line feed.
    written = F.regexp_replace("text", "\\n\\z", "")
    return read.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.md5(written).alias("digest"))


def tficf_lines(spark, sf):
    """Scores of the sources as documents, from lines."""
    lines = documents(spark, sf, "source").select(F.col("source").alias("doc_id"), "text")
    return _rounded(relevance.tficf_lines(lines))


def score_sinks_roundtrip(spark, sf):
    """Scores written as a table and as sorted lines, read back side by side."""
    table, text = fresh_path(spark, "scores"), fresh_path(spark, "score-lines")
    stay_in_place(spark)
    docs = documents(spark, sf)
    shares = relevance.score_shares(docs)
    scores = relevance.tficf(relevance.with_shares(docs, shares), shares=shares)
    stored = sinks.write_scores(scores, table, relevance.SHARE, shares)
    sinks.write_score_lines(stored, text, compression="gzip", by=relevance.SHARE)
    doc_id, word, score = score_line_fields("value")
    lines = spark.read.text(text).select(
        doc_id.cast("bigint").alias("doc_id"),
        word.alias("word"),
        F.round(score.cast("double"), 9).alias("line_tficf"),
        relevance.SHARE,
    )
    lines = lines.repartition(shares, relevance.SHARE)
    return _rounded(stored).join(lines, [relevance.SHARE, "doc_id", "word"]).drop(relevance.SHARE)


def ordered_lines(spark, sf):
    """Result lines written in one order over all files, and the position each has on reading back."""
    path = fresh_path(spark, "ordered-lines")
    stay_in_place(spark)
    docs = documents(spark, sf)
    shares = relevance.score_shares(docs)
    scores = relevance.tficf(relevance.with_shares(docs, shares, as_lines=False), shares=shares)
    line = score_line("doc_id", "word", "tficf", decimals=6).alias("line")
    sinks.write_ordered(scores.select(relevance.SHARE, "doc_id", "word", line), path, "doc_id", "word", by=relevance.SHARE)
    return sinks.read_ordered(spark, path, by=relevance.SHARE).select("position", "line")


QUERIES = {
    "tficf_legal": tficf_legal,
    "tficf_raw": tficf_raw,
    "tficf_by_corpus": tficf_by_corpus,
    "tficf_via_union": tficf_via_union,
    "tficf_sorted": tficf_sorted,
    "tficf_lines": tficf_lines,
    "tf_icf_join": tf_icf_join,
    "word_count_legal": word_count_legal,
    "word_count_raw": word_count_raw,
    "doc_size_legal": doc_size_legal,
    "doc_size_raw": doc_size_raw,
    "doc_frequency": doc_frequency,
    "corpus_size": corpus_size,
    "vocabulary": vocabulary,
    "vocabulary_size": vocabulary_size,
    "postings": postings,
    "term_frequency": term_frequency,
    "inverse_corpus_frequency": inverse_corpus_frequency,
    "score_lines": score_lines,
    "raw_tokens": raw_token_rows,
    "raw_tokens_leading_empty": raw_tokens_leading_empty,
    "legal_words": legal_words,
    "corpus_files_roundtrip": corpus_files_roundtrip,
    "corpus_whole_files": corpus_whole_files,
    "score_sinks_roundtrip": score_sinks_roundtrip,
    "ordered_lines": ordered_lines,
}

_LANG = "with " + _LEGAL.format(extra="lang,") + """,
wc as (select lang, doc_id, word, count(*) wc from tok group by all),
ds as (select lang, doc_id, sum(wc)::bigint ds from wc group by all),
dfr as (select lang, word, count(*) df from wc group by all),
n as (select lang, count(*) n from documents group by lang)
select lang, doc_id, word,
  round(log10(wc.wc::double / ds.ds + 1.0) * log10((n.n + 1)::double / (dfr.df + 1)), 9) tficf
from wc join ds using (lang, doc_id) join dfr using (lang, word) join n using (lang)
"""
_SOURCE_TOK = _LEGAL.format(extra="").replace("select doc_id,", "select source,").replace(
    "select source,  unnest", "select source, unnest"
)
_SOURCE_WC = "with " + _SOURCE_TOK + """,
wc as (select source doc_id, word, count(*) wc from tok group by all)
"""

ORACLES = {
    "corpus_whole_files": """select doc_id, md5(text) digest from documents
union all select -1, md5('') union all select -2, md5('')""",
    "tficf_legal": _LEGAL_CTE + _SCORE,
    "tficf_raw": _RAW_CTE + _SCORE,
    "tficf_by_corpus": _LANG,
    "tficf_via_union": _LEGAL_CTE + _SCORE,
    "tficf_sorted": _LEGAL_CTE + _SCORE + " order by doc_id, word",
    "tficf_lines": _SOURCE_WC
    + """,
ds as (select doc_id, sum(wc)::bigint ds from wc group by all),
dfr as (select word, count(*) df from wc group by all),
n as (select count(distinct source) n from documents)
select doc_id, word,
  round(log10(wc.wc::double / ds.ds + 1.0) * log10((n.n + 1)::double / (dfr.df + 1)), 9) tficf
from wc join ds using (doc_id) join dfr using (word), n""",
    "tf_icf_join": _LEGAL_CTE
    + "select doc_id, word, round(tf, 9) tf, round(icf, 9) icf, round(s, 9) tficf from score",
    "word_count_legal": _LEGAL_CTE + "select doc_id, word, wc from wc",
    "word_count_raw": _RAW_CTE + "select doc_id, word, wc from wc",
    "doc_size_legal": _LEGAL_CTE + "select doc_id, ds from ds",
    "doc_size_raw": _RAW_CTE + "select doc_id, ds from ds",
    "doc_frequency": _LEGAL_CTE + "select word, df from dfr",
    "corpus_size": "select count(*) n_docs from documents",
    "vocabulary": _LEGAL_CTE + "select word from dfr",
    "vocabulary_size": _LEGAL_CTE + "select count(*) n_words from dfr",
    "postings": _LEGAL_CTE
    + """select word, df, segment,
  string_agg(doc_id::varchar, ',' order by doc_id) docs
from (select wc.word, df, doc_id,
        ('0x' || substr(md5(doc_id::varchar), 1, 8))::bigint % ceil(df / 256.0)::bigint segment
      from wc join dfr using (word))
group by word, df, segment""",
    "term_frequency": _LEGAL_CTE + "select doc_id, word, round(tf, 9) tf from tf",
    "inverse_corpus_frequency": _LEGAL_CTE + "select word, round(icf, 9) icf from icf",
    "score_lines": _LEGAL_CTE
    + "select doc_id::varchar || '@' || word || chr(9) || printf('%.6f', s) line from score",
    "raw_tokens": "with " + _RAW_TOK + " select doc_id, word from tok",
    "raw_tokens_leading_empty": r"""select doc_id,
  unnest(regexp_split_to_array(regexp_replace(' ' || text || chr(32) || chr(10), '\s+$', ''), '\s+')) word
from documents""",
    "legal_words": "with " + _LEGAL_TOK + " select doc_id, word from tok",
    "corpus_files_roundtrip": _SOURCE_WC + "select doc_id, word, wc from wc",
    "ordered_lines": _LEGAL_CTE
    + """select row_number() over (order by doc_id, word) as position,
  doc_id::varchar || '@' || word || chr(9) || printf('%.6f', s) line from score""",
    "score_sinks_roundtrip": _LEGAL_CTE
    + "select doc_id, word, round(s, 9) tficf, round(s, 9) line_tficf from score",
}
