"""Dataset jobs: filters, question rows, splits, class weights, training and evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkdesk.operators.quantiles import first_in_seeded_order, whole_table

# Label -> questions asked about a report of that kind, and the system line of chat rows.
QUESTIONS = {
    "사업보고서": ("이 사업보고서에서 회사의 주요 사업 내용을 요약해줘.", "이 공시에서 언급된 회사의 재무 현황을 설명해줘.", "이 사업보고서의 핵심 리스크 요인은 무엇인가?"),
    "감사보고서": ("이 감사보고서의 감사 의견을 요약해줘.", "감사 과정에서 발견된 주요 사항은 무엇인가?", "이 공시에서 감사인이 강조한 핵심 감사사항을 설명해줘."),
    "유상증자": ("이 유상증자 공시의 목적과 규모를 설명해줘.", "이 공시에서 유상증자로 조달된 자금은 어떻게 사용될 예정인가?", "유상증자 발행 조건(발행가액, 주식 수 등)을 정리해줘."),
    "자기주식": ("이 자기주식 취득 공시의 목적과 규모를 설명해줘.", "자기주식 취득 기간과 방법을 정리해줘.", "이 공시에서 자기주식 취득이 주주에게 미치는 영향은?"),
    "전환사채": ("이 전환사채 발행 공시의 주요 조건을 요약해줘.", "전환사채의 전환가액과 전환 기간을 설명해줘.", "이 전환사채 발행의 목적과 자금 사용 계획을 정리해줘."),
    "합병·분할": ("이 합병·분할 공시의 목적과 구조를 설명해줘.", "합병 비율과 일정을 정리해줘.", "이 공시에서 합병·분할이 주주에게 미치는 영향은?"),
}
LABEL_ORDER = ("감사보고서", "사업보고서", "유상증자", "전환사채", "자기주식", "합병·분할")


def long_enough(df: DataFrame, text: str = "text", min_chars: int = 100) -> DataFrame:
    """Texts longer than a minimum."""
    return df.where(F.length(text) > min_chars)


def title_fallback(df: DataFrame, text: str = "text", title: str = "report_nm", min_chars: int = 100, min_rate: float = 0.5) -> DataFrame:
    """Where too few texts are usable, the unusable ones are replaced by their titles."""
    ok = F.length(text) > min_chars
    rate = df.agg(F.avg(F.coalesce(ok, F.lit(False)).cast("double"))).scalar()
    swap = (rate < min_rate) & ~F.coalesce(ok, F.lit(False))
    return df.withColumn(text, F.when(swap, F.col(title)).otherwise(F.col(text)))


def ask_questions(docs: DataFrame, questions: dict[str, Sequence[str]] = QUESTIONS, per_doc: int = 2) -> DataFrame:
    """Each document beside the first ``per_doc`` questions of its label.

    The question lists are a literal map, looked up by label; no join takes place.
    """
    lists = F.create_map(*[x for k, qs in questions.items() for x in (F.lit(k), F.array(*[F.lit(q) for q in qs]))])
    asked = F.slice(F.try_element_at(lists, F.col("label")), 1, per_doc)
    return docs.select("*", F.posexplode(asked).alias("question_no", "instruction"))


def _window(text: Column | str, chars: int | None) -> Column:
    """A text, whole unless the caller names the window of its model."""
    text = F.col(text) if isinstance(text, str) else text
    return text if chars is None else F.substring(text, 1, chars)


def prompt_rows(asked: DataFrame, text_chars: int | None = None) -> DataFrame:
    """Prompt text of each question."""
    prompt = F.concat(
        F.lit("다음은 공시된 '"), F.col("label"), F.lit("' 문서입니다.\n\n[공시 본문]\n"), _window("text", text_chars), F.lit("\n\n[질문]\n"),
        F.col("instruction"))
    return asked.withColumn("prompt", prompt)


def instruction_rows(answered: DataFrame, input_chars: int | None = None, min_answer: int = 20) -> DataFrame:
    """Instruction records of answers that are long enough."""
    answer = F.trim("answer")
    return answered.where(F.length(answer) >= min_answer).select(
        F.col("instruction"), _window("text", input_chars).alias("input"), answer.alias("output"), "label",
        F.col("rcept_no").cast("string").alias("_rcept_no"))


def chat_rows(records: DataFrame, system: str, input_chars: int | None = None) -> DataFrame:
    """Chat-format training text."""
    body = F.concat(F.lit("[공시 본문]\n"), _window("input", input_chars), F.lit("\n\n[질문]\n"), F.col("instruction"))
    user = F.when(F.coalesce(F.col("input"), F.lit("")) != "", body).otherwise(F.col("instruction"))
    mark, end = (lambda who: F.lit(f"[|{who}|]")), F.lit("[|endofturn|]")
    return records.select(
        "*", F.concat(mark("system"), F.lit(system), end, mark("user"), user, end, mark("assistant"), F.col("output"), end).alias("chat"))


def new_questions(asked: DataFrame, stored: DataFrame) -> DataFrame:
    """Question rows whose (document, question) is not stored yet."""
    keys = stored.select(F.col("_rcept_no").alias("rcept_key"), "instruction").distinct()
    return asked.withColumn("rcept_key", F.col("rcept_no").cast("string")).join(
        keys, ["rcept_key", "instruction"], "left_anti").drop("rcept_key")


# --- samples and splits -----------------------------------------------------------------------------
def cap_class(df: DataFrame, label: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """At most n rows per class, chosen in seeded order."""
    return first_in_seeded_order(df, [label], key, lambda size: F.lit(n), seed).where("chosen").drop("chosen")


def head_per_period(df: DataFrame, keys: list[str], order: str, n: int) -> DataFrame:
    """First n rows per class and period."""
    w = W.partitionBy(*keys).orderBy(order)
    return df.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= n).drop("rk")


def stratified_split(df: DataFrame, label: str, key: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Deterministic split with the same share of every class: column ``part``."""
    out = first_in_seeded_order(df, [label], key, lambda n: F.round(n * test_share, 0).cast("bigint"), seed)
    return out.withColumn("part", F.when(F.col("chosen"), "test").otherwise("train")).drop("chosen")


def random_split(df: DataFrame, key: str, test_share: float = 0.1, seed: int = 42) -> DataFrame:
    """Deterministic split of the whole table."""
    out = first_in_seeded_order(df.withColumn("_all", whole_table(key)), ["_all"], key, lambda n: F.ceil(n * test_share), seed)
    return out.withColumn("part", F.when(F.col("chosen"), "test").otherwise("train")).drop("chosen", "_all")


def temporal_split(df: DataFrame, date: str, test_year: int, label: str, key: str, val_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Test is one year; earlier rows are split into train and validation per class."""
    year = F.substring(date, 1, 4).try_cast("int")
    test = df.where(year == test_year).withColumn("part", F.lit("test"))
    rest = stratified_split(df.where(year < test_year), label, key, val_share, seed)
    return test.unionByName(rest.withColumn("part", F.when(F.col("part") == "test", "val").otherwise("train")))


def slice_rows(df: DataFrame, order: list[str], skip: int = 0, limit: int | None = None) -> DataFrame:
    """Ordered slice for restarts and trial runs."""
    out = df.orderBy(*order).offset(skip)
    return out if limit is None else out.limit(limit)


# --- labels and weights ---------------------------------------------------------------------------
def encode_labels(df: DataFrame, names: Sequence[str] = LABEL_ORDER, label: str = "label") -> DataFrame:
    """Integer id of each known label; rows with other labels or none are left to ``unknown_labels``."""
    ids = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    return df.withColumn("label_id", F.try_element_at(ids, F.col(label))).where("label_id IS NOT NULL")


def unknown_labels(df: DataFrame, names: Sequence[str] = LABEL_ORDER, label: str = "label") -> DataFrame:
    """Rows per label that is not in the list, rows without a label included."""
    return df.where(F.col(label).isNull() | ~F.col(label).isin(*names)).groupBy(label).agg(F.count("*").alias("n"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k * n_class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"), F.count("*").alias("k"))
    weight = total.select("total").scalar() / (total.select("k").scalar() * F.col("n"))
    return counts.withColumn("weight", weight)


# --- training, scoring, evaluation -------------------------------------------------------------------
def text_classifier(label: str = "label", text: str = "text", features: int = 1 << 14, max_iter: int = 30) -> Pipeline:
    """Words -> hashed term weights -> logistic regression with class weights."""
    return Pipeline(stages=[
        StringIndexer(inputCol=label, outputCol="label_index", stringOrderType="alphabetAsc"),
        RegexTokenizer(inputCol=text, outputCol="words", pattern=r"[^\p{L}]+"),
        HashingTF(inputCol="words", outputCol="tf", numFeatures=features),
        IDF(inputCol="tf", outputCol="features"),
        LogisticRegression(labelCol="label_index", featuresCol="features", weightCol="weight", maxIter=max_iter, regParam=0.01),
    ])


def train_classifier(train: DataFrame, label: str = "label", text: str = "text", **options):
    """Fit the classifier with balanced class weights."""
    weights = class_weights(train, label).select(label, "weight")
    return text_classifier(label, text, **options).fit(train.join(weights, label))


def score_texts(model, df: DataFrame, max_chars: int | None = None, text: str = "text") -> DataFrame:
    """Predicted label and its probability, four decimals, for each text."""
    from pyspark.ml.functions import vector_to_array

    names = F.array(*[F.lit(n) for n in model.stages[0].labels])
    src = df if max_chars is None else df.withColumn(text, F.substring(text, 1, max_chars))
    out = model.stages[-1].transform(_features(model, src))
    return out.select(
        *df.columns, F.element_at(names, (F.col("prediction") + 1).cast("int")).alias("pred"),
        F.round(F.array_max(vector_to_array("probability")), 4).alias("score"))


def _features(model, df: DataFrame) -> DataFrame:
    for stage in model.stages[1:-1]:
        df = stage.transform(df)
    return df


def confusion(df: DataFrame, truth: str = "label", pred: str = "pred") -> DataFrame:
    """Rows per (truth, prediction)."""
    return df.groupBy(truth, pred).agg(F.count("*").alias("n"))


def classification_report(df: DataFrame, truth: str = "label", pred: str = "pred") -> DataFrame:
    """Precision, recall, F1 and support per class (X22), from the confusion counts."""
    cells = confusion(df, truth, pred)
    by_truth = cells.groupBy(F.col(truth).alias("class")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col(truth) == F.col(pred), F.col("n")).otherwise(0)).alias("hit"))
    by_pred = cells.groupBy(F.col(pred).alias("class")).agg(F.sum("n").alias("predicted"))
    both = by_truth.join(by_pred, "class", "full").fillna(0)
    safe = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    out = both.withColumn("precision", safe(F.col("hit"), F.col("predicted"))).withColumn("recall", safe(F.col("hit"), F.col("support")))
    return out.withColumn("f1", safe(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))).select(
        "class", "precision", "recall", "f1", "support")


def evaluation_summary(df: DataFrame, truth: str = "label", pred: str = "pred") -> DataFrame:
    """Accuracy and macro F1."""
    report = classification_report(df, truth, pred)
    acc = F.sum(F.col("recall") * F.col("support")) / F.sum("support")
    return report.agg(acc.alias("accuracy"), F.avg("f1").alias("macro_f1"), F.sum("support").alias("n"))


