"""Training: the model learned from DataFrame aggregations.

Vocabulary, idf and chi-squared cells come from a few passes over landed words,
then the solver iterates over landed vectors. The fitted pipeline holds only
the selected terms, in the order of the full feature vector, so scoring never
builds the slots that selection drops; ``Spec(full=True)`` keeps all term
vectors and cuts them at the end.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    NGram,
    SQLTransformer,
    StringIndexerModel,
    Tokenizer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

from tidemark.functions.text import clean_sql
from tidemark.operators.chi2 import chi2_select, chi2_stats, label_totals
from tidemark.operators.evaluate import confusion_counts, confusion_matrix, eval_metrics
from tidemark.operators.labels import describe_labels, split_usable
from tidemark.operators.terms import known_terms, tfidf, weighted_vocabulary, with_words
from tidemark.schemas import CLEANED, WORDS
from tidemark.session import land, local_table


@dataclass(frozen=True)
class Spec:
    """Columns and sizes of the model; the defaults are fixed values.

    ``full`` keeps the term vectors of the whole vocabulary in the output
    (``1_tf`` … ``3_tfidf``, ``rawFeatures``) instead of the selected slots.
    """

    text: str = "tweet"
    target: str = "target"
    max_n: int = 3
    vocab_size: int = 2**14
    min_doc_freq: int = 5
    top_features: int = 2**14
    reg_param: float = 0.1
    elastic_net: float = 0.0
    max_iter: int = 1000
    full: bool = False

    @property
    def sizes(self) -> range:
        return range(1, self.max_n + 1)


@dataclass(frozen=True)
class Selection:
    """What the solver starts from: landed words, vocabulary, chosen features and label rows."""

    words: DataFrame
    vocab: DataFrame
    chosen: DataFrame
    labels: dict[str, int]


def cleaner(spec: Spec) -> SQLTransformer:
    """Cleaning as a SQL statement, so that it is saved with the model."""
    return SQLTransformer(statement=f"SELECT *, {clean_sql(spec.text)} AS {CLEANED} FROM __THIS__")


def solver(spec: Spec) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="features",
        labelCol="label",
        regParam=spec.reg_param,
        elasticNetParam=spec.elastic_net,
        maxIter=spec.max_iter,
    )


def select_features(train: DataFrame, spec: Spec = Spec()) -> Selection:
    """Vocabulary and chi-squared selection; the text is cleaned once."""
    label = F.col(spec.target).cast("string").alias("label")
    words = land(with_words(train.select(F.col(spec.text), label), spec.text).select("label", WORDS), "words")
    totals = label_totals(words)
    # A class list; the fitted label index holds it on the driver as well.
    labels = {row.label: row.label_rows for row in sorted(totals.collect())}
    if not labels:
        raise ValueError("no row with text and label to train on")
    n_docs = sum(labels.values())
    vocab = weighted_vocabulary(words, spec.max_n, spec.vocab_size, n_docs, spec.min_doc_freq)
    vocab = land(vocab, "vocabulary")
    varying = land(vocab.filter("idf <> 0").select("n", "term", "feature"), "varying-terms")
    found = known_terms(words, varying, spec.max_n, ("label",), ["feature"])
    chosen = chi2_select(chi2_stats(found, totals), vocab, spec.top_features)
    return Selection(words, vocab, land(chosen, "features"), labels)


def feature_stages(selection: Selection, spec: Spec = Spec()) -> list:
    """Fitted stages up to the feature vector.

    The terms of these stages (at most ``top_features`` rows, or the whole
    vocabulary of ``max_n * vocab_size``) reach the driver, as they do in any
    fitted vocabulary.
    """
    kept = selection.vocab if spec.full else selection.chosen
    rows = kept.select("n", "feature", "term", "idf").orderBy("feature").collect()
    terms: dict[int, list] = {n: [] for n in spec.sizes}
    for row in rows:
        terms[row.n].append((row.term, row.idf))
    stages = [cleaner(spec), Tokenizer(inputCol=CLEANED, outputCol=WORDS)]
    outputs = []
    for n, known in terms.items():
        if not known:
            continue
        # 1-grams are the words: reading those leaves the copy to be pruned.
        source = WORDS if n == 1 else f"{n}_grams"
        stages += [
            NGram(n=n, inputCol=WORDS, outputCol=f"{n}_grams"),
            CountVectorizerModel.from_vocabulary([term for term, _ in known], inputCol=source, outputCol=f"{n}_tf"),
            ElementwiseProduct(
                scalingVec=Vectors.dense([weight for _, weight in known]), inputCol=f"{n}_tf", outputCol=f"{n}_tfidf"
            ),
        ]
        outputs.append(f"{n}_tfidf")
    stages.append(VectorAssembler(inputCols=outputs, outputCol="rawFeatures" if spec.full else "features"))
    if spec.full:
        wanted = {row.feature for row in selection.chosen.select("feature").collect()}
        places = [i for i, row in enumerate(rows) if row.feature in wanted]
        stages.append(VectorSlicer(inputCol="rawFeatures", outputCol="features", indices=places))
    stages.append(StringIndexerModel.from_labels(list(selection.labels), inputCol=spec.target, outputCol="label"))
    return stages


def stage_columns(stage, *params: str) -> str | None:
    """The columns that a stage's parameters name, those that are set, joined by commas."""
    named = [stage.getOrDefault(p) for p in params if stage.hasParam(p) and stage.isDefined(p)]
    columns = [c for value in named for c in ([value] if isinstance(value, str) else value)]
    return ",".join(columns) or None


def describe_stages(spark, stages) -> DataFrame:
    """Position, class and size of each stage (terms, slots, labels or coefficients it holds), and the
    columns it reads and makes; those of a SQL statement are not told by its parameters."""

    def size(stage) -> int | None:
        if isinstance(stage, CountVectorizerModel):
            return len(stage.vocabulary)
        if isinstance(stage, ElementwiseProduct):
            return len(stage.getScalingVec())
        if isinstance(stage, StringIndexerModel):
            return len(stage.labels)
        if isinstance(stage, VectorSlicer):
            return len(stage.getIndices())
        return stage.numFeatures if isinstance(stage, LogisticRegressionModel) else None

    rows = [
        (
            i,
            type(stage).__name__,
            size(stage),
            stage_columns(stage, "inputCol", "inputCols", "featuresCol"),
            stage_columns(stage, "outputCol", "outputCols", "predictionCol"),
        )
        for i, stage in enumerate(stages)
    ]
    return local_table(spark, rows, ("position", "stage", "size", "inputs", "output"))


def describe_fitted_labels(spark, labels: dict[str, int]) -> DataFrame:
    """The label dictionary of a fit with the rows it learned each label from."""
    rows = [(label, float(i), n) for i, (label, n) in enumerate(labels.items())]
    return describe_labels(local_table(spark, rows, ("label", "label_index", "n")))


def fit_selected(train: DataFrame, selection: Selection, spec: Spec = Spec()) -> PipelineModel:
    stages = feature_stages(selection, spec)
    vectors = PipelineModel(stages).transform(train.select(spec.text, spec.target))
    # Landed: the solver reads its input several times, and a lost executor must not redo the text.
    data = land(vectors.select("label", "features"), "solver-input")
    return PipelineModel(stages + [solver(spec).fit(data)])


def fit(train: DataFrame, spec: Spec = Spec()) -> PipelineModel:
    """Learn the model; rows without text or label are left out."""
    usable, _ = split_usable(train, spec.text, spec.target)
    return fit_selected(usable, select_features(usable, spec), spec)


def gradient(train: DataFrame, model: PipelineModel, selection: Selection, spec: Spec = Spec()) -> DataFrame:
    """``(n, features, largest)``: features per n-gram size and the largest slope of the penalised loss.

    At the solution all slopes are near 0. They are taken in the solver's
    scaled space and summed in long form over all training rows, without the
    vectors: from the stored coefficients, the words and the chosen vocabulary.
    """
    spark = train.sparkSession
    last = model.stages[-1]
    features = [row.feature for row in selection.chosen.select("feature").orderBy("feature").collect()]
    weights = local_table(spark, zip(features, last.coefficients.toArray().tolist()), ("feature", "coefficient"))
    weights = land(weights, "coefficients")
    label = F.col(spec.target).cast("string").alias("label")
    posts = with_words(train.select(F.col(spec.text), label), spec.text).select("label", WORDS)
    posts = land(posts.withColumn("post", F.monotonically_increasing_id()), "gradient-words")
    vocab = selection.chosen.select("n", "term", "feature", "idf").join(weights, "feature")
    values = tfidf(posts, land(vocab.drop("coefficient"), "gradient-terms"), spec.max_n, ("post",))
    values = land(values.select("post", "n", "feature", F.col("tfidf").alias("x")), "gradient-values")
    dots = values.join(weights, "feature").groupBy("post").agg(F.sum(F.col("x") * F.col("coefficient")).alias("dot"))
    positive = list(selection.labels)[-1]
    margin = F.coalesce("dot", F.lit(0.0)) + last.intercept
    error = 1 / (1 + F.exp(-margin)) - (F.col("label") == positive).cast("double")
    errors = land(posts.select("post", "label").join(dots, "post", "left").select("post", error.alias("error")), "errors")
    n = F.lit(float(sum(selection.labels.values())))
    sums = values.join(errors, "post").groupBy("n", "feature").agg(
        F.sum(F.col("x") * F.col("error")).alias("pull"), F.sum("x").alias("sum"), F.sum(F.col("x") * F.col("x")).alias("squares")
    )
    spread = F.sqrt(F.greatest((F.col("squares") - F.col("sum") * F.col("sum") / n) / (n - 1), F.lit(0.0)))
    slopes = sums.join(weights, "feature").withColumn("spread", spread)
    slope = F.abs(F.col("pull") / n / F.col("spread") + spec.reg_param * F.col("coefficient") * F.col("spread"))
    slopes = slopes.select("n", "feature", F.when(F.col("spread") > 1e-9, slope).otherwise(F.abs("coefficient")).alias("slope"))
    largest = slopes.groupBy("n").agg(F.max("slope").alias("largest"))
    sizes = selection.chosen.groupBy("n").agg(F.count("*").alias("features"))
    return sizes.join(largest, "n", "left").select("n", "features", F.coalesce("largest", F.lit(0.0)).alias("largest"))


def evaluate(model: PipelineModel, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scores and confusion matrix, from one pass over the predictions."""
    counts = land(confusion_counts(model.transform(test).select("label", "prediction")), "confusion")
    return eval_metrics(counts), confusion_matrix(counts)
