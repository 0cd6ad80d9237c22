"""Dataset queries: filters, question rows, samples, splits, weights, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdesk.operators import datasets as Z
from sparkdesk.plans.demand import r
from sparkdesk.plans.registry import query
from sparkdesk.plans.tables import FILINGS

# report kind standing in for each language of the test corpus; Spanish stays unknown
KINDS = {"en": "사업보고서", "de": "감사보고서", "fr": "유상증자"}
KIND_SQL = "CASE label WHEN 'en' THEN '사업보고서' WHEN 'de' THEN '감사보고서' WHEN 'fr' THEN '유상증자' ELSE '기타' END"


def kinded(t):
    kind = F.lit("기타")
    for lang, name in KINDS.items():
        kind = F.when(F.col("label") == lang, name).otherwise(kind)
    return t.filings.withColumn("label", kind)


@query("x14_long_enough", f"WITH {FILINGS} SELECT rcept_no FROM filings WHERE length(text) > 200")
def _(t):
    return Z.long_enough(t.filings, min_chars=200).select("rcept_no")


@query("x14_title_fallback", f"""WITH {FILINGS}, z AS (SELECT avg(CASE WHEN length(text) > 5000 THEN 1.0 ELSE 0.0 END) AS rate FROM filings)
  SELECT rcept_no, CASE WHEN rate < 0.5 AND NOT length(text) > 5000 THEN report_nm ELSE text END AS text FROM filings, z""")
def _(t):
    return Z.title_fallback(t.filings, min_chars=5000).select("rcept_no", "text")


_Q = " UNION ALL ".join(
    f"SELECT '{k}' AS label, CAST({i} AS INTEGER) AS question_no, '{q}' AS instruction" for k, qs in Z.QUESTIONS.items() for i, q in enumerate(qs) if i < 2)
ASKED = f"""{FILINGS}, kinded AS (SELECT rcept_no, corp_name, text, {KIND_SQL} AS label FROM filings), q AS ({_Q}),
  asked AS (SELECT k.*, q.question_no, q.instruction FROM kinded k JOIN q USING (label))"""


@query("j10_ask_questions", f"WITH {ASKED} SELECT rcept_no, label, question_no, instruction FROM asked")
def _(t):
    return Z.ask_questions(kinded(t)).select("rcept_no", "label", "question_no", "instruction")


@query("x15_prompt_rows", f"""WITH {ASKED} SELECT rcept_no, question_no, '다음은 공시된 ''' || label || ''' 문서입니다.' || chr(10) || chr(10) || '[공시 본문]' || chr(10) || text
  || chr(10) || chr(10) || '[질문]' || chr(10) || instruction AS prompt FROM asked""")
def _(t):
    return Z.prompt_rows(Z.ask_questions(kinded(t))).select("rcept_no", "question_no", "prompt")


ANSWERED = f"""{ASKED}, ins AS (SELECT instruction, text AS input, trim(a) AS output, label, CAST(rcept_no AS VARCHAR) AS _rcept_no
  FROM (SELECT *, string_split(text, chr(10))[1 + question_no] AS a FROM asked) WHERE length(trim(a)) >= 20)"""


def answered(t):
    """Answers stood in for by a line of the text itself."""
    asked = Z.ask_questions(kinded(t))
    return Z.instruction_rows(asked.withColumn("answer", F.get(F.split("text", "\n", -1), F.col("question_no"))))


@query("x15_instruction_rows", f"WITH {ANSWERED} SELECT * FROM ins")
def _(t):
    return answered(t)


@query("x16_chat_rows", f"""WITH {ANSWERED} SELECT _rcept_no, instruction, '[|system|]S[|endofturn|][|user|]' || '[공시 본문]' || chr(10) || input || chr(10) || chr(10) || '[질문]' || chr(10)
  || instruction || '[|endofturn|][|assistant|]' || output || '[|endofturn|]' AS chat FROM ins""")
def _(t):
    return Z.chat_rows(answered(t), "S").select("_rcept_no", "instruction", "chat")


@query("s14_new_questions", f"WITH {ASKED} SELECT rcept_no, question_no FROM asked WHERE NOT (label = '사업보고서' AND question_no = 0)")
def _(t):
    asked = Z.ask_questions(kinded(t))
    stored = asked.where("label = '사업보고서' AND question_no = 0").select(F.col("rcept_no").cast("string").alias("_rcept_no"), "instruction")
    return Z.new_questions(asked, stored).select("rcept_no", "question_no")


# --- samples and splits --------------------------------------------------------------------------------
H = "substr(md5('42:' || rcept_no), 1, 13)"


@query("w16_head_per_period", f"WITH {FILINGS} SELECT label, rcept_dt, rcept_no FROM (SELECT *, row_number() OVER (PARTITION BY label, rcept_dt ORDER BY rcept_no) AS k FROM filings) WHERE k <= 5")
def _(t):
    return Z.head_per_period(t.filings.drop("text"), ["label", "rcept_dt"], "rcept_no", 5).select("label", "rcept_dt", "rcept_no")


@query("w17_cap_class", f"WITH {FILINGS} SELECT label, rcept_no FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {H}) AS k FROM filings) WHERE k <= 50")
def _(t):
    return Z.cap_class(t.filings.select("label", "rcept_no"), "label", "rcept_no", 50)


@query("w18_slice_rows", f"WITH {FILINGS} SELECT rcept_no, label FROM filings ORDER BY rcept_no LIMIT 100 OFFSET 40")
def _(t):
    return Z.slice_rows(t.filings.select("rcept_no", "label"), ["rcept_no"], 40, 100)


@query("x17_random_split", f"""WITH {FILINGS}, k AS (SELECT rcept_no, row_number() OVER (ORDER BY {H}) AS k, count(*) OVER () AS n FROM filings)
  SELECT rcept_no, CASE WHEN k <= ceil(n * 0.1) THEN 'test' ELSE 'train' END AS part FROM k""")
def _(t):
    return Z.random_split(t.filings.select("rcept_no"), "rcept_no")


@query("x17_stratified_split", f"""WITH {FILINGS}, k AS (SELECT rcept_no, label, row_number() OVER (PARTITION BY label ORDER BY {H}) AS k, count(*) OVER (PARTITION BY label) AS n FROM filings)
  SELECT rcept_no, label, CASE WHEN k <= round(n * 0.2, 0) THEN 'test' ELSE 'train' END AS part FROM k""")
def _(t):
    return Z.stratified_split(t.filings.select("rcept_no", "label"), "label", "rcept_no")


@query("x18_temporal_split", f"""WITH {FILINGS}, k AS (SELECT rcept_no, label, row_number() OVER (PARTITION BY label ORDER BY {H}) AS k, count(*) OVER (PARTITION BY label) AS n FROM filings WHERE substr(rcept_dt, 1, 4) < '2024')
  SELECT rcept_no, label, CASE WHEN k <= round(n * 0.2, 0) THEN 'val' ELSE 'train' END AS part FROM k UNION ALL SELECT rcept_no, label, 'test' FROM filings WHERE substr(rcept_dt, 1, 4) = '2024'""")
def _(t):
    return Z.temporal_split(t.filings.select("rcept_no", "label", "rcept_dt"), "rcept_dt", 2024, "label", "rcept_no").drop("rcept_dt")


# --- labels, weights, evaluation -----------------------------------------------------------------------
@query("x19_encode_labels", f"WITH {FILINGS} SELECT rcept_no, CAST(CASE label WHEN 'en' THEN 1 WHEN 'de' THEN 0 WHEN 'fr' THEN 2 END AS INTEGER) AS label_id FROM filings WHERE label IN ('en', 'de', 'fr')")
def _(t):
    return Z.encode_labels(kinded(t)).select("rcept_no", "label_id")


@query("x19_unknown_labels", f"WITH {FILINGS} SELECT '기타' AS label, count(*) AS n FROM filings WHERE label NOT IN ('en', 'de', 'fr') HAVING count(*) > 0")
def _(t):
    return Z.unknown_labels(kinded(t))


@query("x20_class_weights", f"WITH {FILINGS}, c AS (SELECT label, count(*) AS n FROM filings GROUP BY 1) SELECT label, n, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n), 6) AS weight FROM c")
def _(t):
    return r(Z.class_weights(t.filings, "label"))


def guessed(t):
    """Language guessed from marker words: a simple prediction to evaluate."""
    has = lambda w: F.col("text").contains(w)
    pred = F.when(has(" der ") | has(" und "), "de").when(has(" les ") | has(" le "), "fr").when(has(" el "), "es").otherwise("en")
    return t.filings.select("label", pred.alias("pred"))


GUESS = f"""{FILINGS}, g AS (SELECT label, CASE WHEN contains(text, ' der ') OR contains(text, ' und ') THEN 'de' WHEN contains(text, ' les ') OR contains(text, ' le ') THEN 'fr'
  WHEN contains(text, ' el ') THEN 'es' ELSE 'en' END AS pred FROM filings)"""
REPORT = f"""{GUESS}, cls AS (SELECT DISTINCT label AS class FROM g UNION SELECT DISTINCT pred FROM g),
  rep AS (SELECT class, (SELECT count(*) FROM g WHERE label = class) AS support, (SELECT count(*) FROM g WHERE pred = class) AS predicted, (SELECT count(*) FROM g WHERE label = class AND pred = class) AS hit FROM cls),
  prf AS (SELECT class, support, coalesce(hit / CAST(nullif(predicted, 0) AS DOUBLE), 0.0) AS precision, coalesce(hit / CAST(nullif(support, 0) AS DOUBLE), 0.0) AS recall FROM rep),
  fin AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM prf)"""


@query("x22_confusion", f"WITH {GUESS} SELECT label, pred, count(*) AS n FROM g GROUP BY 1, 2")
def _(t):
    return Z.confusion(guessed(t))


@query("x22_classification_report", f"WITH {REPORT} SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM fin")
def _(t):
    return r(Z.classification_report(guessed(t)))


@query("x22_evaluation_summary", f"WITH {REPORT} SELECT round(sum(recall * support) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS macro_f1, CAST(sum(support) AS BIGINT) AS n FROM fin")
def _(t):
    return r(Z.evaluation_summary(guessed(t)))


def trained(t):
    parts = Z.temporal_split(t.filings.select("rcept_no", "label", "rcept_dt", "text"), "rcept_dt", 2024, "label", "rcept_no")
    return Z.train_classifier(parts.where("part = 'train'")), parts.where("part = 'test'")


@query("x21_train_classifier")
def _(t):
    model, test = trained(t)
    return r(Z.evaluation_summary(Z.score_texts(model, test)))


@query("x23_score_texts")
def _(t):
    model, test = trained(t)
    return Z.score_texts(model, test.select("rcept_no", "label", "text")).select("rcept_no", "label", "pred", "score")
