"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

A lexicon of words and word beginnings is learned from labelled documents and
joined to a short fixed list. Every whole text gives densities of lexicon words,
their nearness to the second person, rates of capitals, punctuation and
obfuscation. Trees are fitted on one part of the labelled sample, and their
margins are calibrated on the other.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.encoding import by_size
from tallyframe.llm.labelled import MAX_ROWS, labelled_texts
from tallyframe.llm.words import Words
from tallyframe.staging import stage

# A starting list of common insults; the learned lexicon is added to it.
SEED_WORDS = frozenset(
    "idiot idiots moron morons stupid scum trash clown clowns loser losers pathetic worthless disgusting "
    "dumb fool imbecile jerk vermin garbage filth coward idiota imbécil estúpido idiote imbécile dumm trottel".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros vuestro".split()
)
_PLAIN = str.maketrans("013457@$!", "oieastasi")
STEM_LENGTHS = (4, 5, 6, 7, 8)
STEM_WORDS = 2
FEATURES = (
    "lexicon_density",
    "lexicon_words",
    "seed_density",
    "second_person_near",
    "second_person_density",
    "capitals",
    "punctuation",
    "obfuscation",
)
_NEAR = 3


@dataclass(frozen=True)
class Lexicon:
    words: frozenset[str]
    stems: frozenset[str]


def plain(word: str) -> str:
    """Letters of a word in lower case, common substitutes undone."""
    lowered = word.lower()
    if not lowered.isalpha():
        lowered = "".join(c for c in lowered.strip(".,;:!?\"'()").translate(_PLAIN) if c.isalpha())
    return lowered


def learn_lexicon(
    sample: DataFrame, max_terms: int = 400, min_documents: int = 4, min_share: float = 0.85
) -> Lexicon:
    """Words and word beginnings that stand almost only in positive documents; reads ``max_terms`` rows.

    A beginning counts as one when ``STEM_WORDS`` words have it, else it would
    only say less than its one word.
    """
    words = F.array_distinct(F.split(F.lower("text"), "[^\\p{L}]+"))
    beginnings = [F.when(F.length("word") > k, F.concat(F.lit("s:"), F.substring("word", 1, k))) for k in STEM_LENGTHS]
    kinds = F.array_compact(F.array(F.concat(F.lit("w:"), F.col("word")), *beginnings))
    terms = (
        sample.select("label", F.explode(words).alias("word"))
        .groupBy("word")
        .agg(F.sum("label").alias("positive"), F.count("*").alias("documents"))
        .select("positive", "documents", F.explode(kinds).alias("term"))
        .groupBy("term")
        .agg(F.sum("positive").alias("positive"), F.sum("documents").alias("documents"), F.count("*").alias("words"))
        .where((F.col("positive") >= min_documents) & (F.col("positive") >= F.col("documents") * min_share))
        .where((F.length("term") > 4) & (F.col("term").startswith("w:") | (F.col("words") >= STEM_WORDS)))
    )
    found = [r["term"] for r in terms.orderBy(F.desc("positive"), "term").limit(max_terms).collect()]
    return Lexicon(
        frozenset(t[2:] for t in found if t[0] == "w") | SEED_WORDS, frozenset(t[2:] for t in found if t[0] == "s")
    )


def _bits(word: str, lexicon: Lexicon) -> int:
    bare = plain(word)
    hit = bare in lexicon.words or (bool(lexicon.stems) and any(len(bare) > k and bare[:k] in lexicon.stems for k in STEM_LENGTHS))
    inner = word.strip(".,;:!?\"'()")
    odd = bool(inner) and not inner.isalpha() and any(c.isalpha() for c in inner)
    return hit | (bare in SEED_WORDS) << 1 | (bare in SECOND_PERSON) << 2 | odd << 3


_UPPER = np.isin(np.arange(256), range(0x41, 0x5B))
_LETTER = _UPPER | np.isin(np.arange(256), range(0x61, 0x7B))
_MARK = np.isin(np.arange(256), list(b"!?*#$%&@"))


def dense_features(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """One row of ``FEATURES`` per text; a text without words has zeros."""
    texts = pc.fill_null(texts, "")
    words = Words(texts, lower=False)
    bits = words.mapped(lambda w: _bits(w, lexicon), np.uint8)
    n = len(texts)
    document = words.documents()
    counts = np.diff(words.bounds)
    size = np.maximum(counts, 1)

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.bincount(document, weights=flags, minlength=n)

    hit, second = bits & 1 > 0, bits & 4 > 0
    near = np.zeros(len(bits), bool)
    for step in range(1, _NEAR + 1):
        same = document[step:] == document[:-step]
        near[step:] |= second[:-step] & same
        near[:-step] |= second[step:] & same
    hits = per_text(hit)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    edges = (offsets - offsets[0]).astype(np.int64)

    def chars(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[raw])])
        return (total[edges[1:]] - total[edges[:-1]]).astype(float)

    length = np.maximum(np.diff(edges), 1)
    return np.column_stack(
        [
            hits / size,
            hits,
            per_text(bits & 2 > 0) / size,
            per_text(hit & near) / size,
            per_text(second) / size,
            chars(_UPPER) / np.maximum(chars(_LETTER), 1),
            chars(_MARK) / length,
            per_text(bits & 8 > 0) / size,
        ]
    )


def with_features(docs: DataFrame, text_col: str, lexicon: Lexicon, *kept: str) -> DataFrame:
    """``(*kept, features)`` of every whole text; ``kept`` may hold the text."""
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("features", T.ArrayType(T.DoubleType()))])
    columns = dict.fromkeys([*kept, text_col])

    def run(batches):
        for batch in batches:
            for part in by_size(batch, text_col):
                made = dense_features(part[text_col], lexicon)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(made.reshape(-1)), len(FEATURES))
                listed = flat.cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*(part[c] for c in kept), listed], names=[*kept, "features"])

    return docs.select(*columns).mapInArrow(run, schema)


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    base_rate: float


def _margins(trees: GBTClassificationModel, features: DataFrame) -> DataFrame:
    vectors = features.withColumn("features", array_to_vector("features"))
    return trees.transform(vectors).withColumn("margin", vector_to_array("rawPrediction")[1])


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    max_rows: int = MAX_ROWS,
    trees: int = 20,
    depth: int = 3,
    max_terms: int = 400,
) -> ToxicityModel:
    """Fit on at most ``max_rows`` labelled documents.

    Four fifths of them, by a hash of the id, choose the lexicon (``max_terms``
    words at most) and grow the trees; the rest calibrates. Without both classes in both parts the model is the base rate
    (a half without any label).
    """
    sample = labelled_texts(docs, labels, label_col, id_col, text_col, max_rows)
    part = F.pmod(F.xxhash64("id", F.lit("calibration")), F.lit(5)) == 0
    lexicon = learn_lexicon(sample.where(~part), max_terms=max_terms)
    made = stage(with_features(sample, "text", lexicon, "id", "label").withColumn("calibrates", part), "toxic-features")
    found = {
        r["calibrates"]: r
        for r in made.groupBy("calibrates").agg(F.count("*").alias("n"), F.sum("label").alias("k")).collect()
    }
    total = sum(r["n"] for r in found.values())
    rate = sum(r["k"] for r in found.values()) / total if total else 0.5
    if len(found) < 2 or any(r["k"] in (0, r["n"]) for r in found.values()):
        return ToxicityModel(lexicon, None, None, rate)
    classifier = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=7, labelCol="label")
    vectors = made.where("not calibrates").withColumn("features", array_to_vector("features"))
    grown = classifier.fit(vectors)
    held = _margins(grown, made.where("calibrates")).select("label", F.col("margin"))
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score").fit(held)
    return ToxicityModel(lexicon, grown, calibration, rate)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, features, score)`` of every row of ``docs``, scores between 0 and 1.

    Repeated rows have equal scores; null and empty texts are scored by their
    zero features; null ids stay; other columns are left out, whatever their
    names; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return _scored(rows, model, "_text", "_id").select(F.col("_id").alias(id_col), "features", "score")


def accepted(docs: DataFrame, model: ToxicityModel, below: float, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose score is below a limit, with all their columns and whatever names those have."""
    names = {c: f"_column{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*(F.col(c).alias(n) for c, n in names.items()))
    scored = _scored(rows, model, names[text_col], *names.values())
    return scored.where(F.col("score") < below).select(*(F.col(n).alias(c) for c, n in names.items()))


def _scored(rows: DataFrame, model: ToxicityModel, text_col: str, *kept: str) -> DataFrame:
    made = with_features(rows, text_col, model.lexicon, *kept)
    if model.trees is None:
        return made.withColumn("score", F.lit(float(model.base_rate)))
    margins = _margins(model.trees, made.withColumn("_kept", F.col("features")))
    scored = model.calibration.transform(margins).withColumn("features", F.col("_kept"))
    return scored.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")))
