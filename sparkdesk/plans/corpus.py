"""Corpus queries: markup, noise, chunks, sections, labels, questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdesk.functions import questions as Qn
from sparkdesk.functions import text as X
from sparkdesk.functions.rules import any_keyword
from sparkdesk.operators import corpus as K
from sparkdesk.operators.ordered import number_rows
from sparkdesk.plans.demand import r
from sparkdesk.plans.registry import query

LATIN = r"\p{L}"  # letter class of the test texts
HEAD = r"^(The|De|Der|La|And|Und|It|Of)"
STRIP = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')".format


def lit(text):
    return "'" + text.replace("'", "''") + "'"


# --- markup ----------------------------------------------------------------------------------------
def _html_sql(col):
    s = f"regexp_replace({col}, '(?s)<!--.*?-->', ' ', 'g')"
    for tag in ("script", "style", "head"):
        s = rf"regexp_replace({s}, '(?is)<{tag}\b[^>]*>.*?</{tag}\s*>', ' ', 'g')"
    s = f"replace(regexp_replace({s}, '<[^>]*>', ' ', 'g'), '&cr;', ' ')"
    for name, char in X.HTML_ENTITIES:
        s = f"replace({s}, {lit(name)}, {lit(char)})"
    return STRIP(rf"regexp_replace({s}, '[\s\p{{Z}}]+', ' ', 'g')")


@query("x01_html_to_text", f"SELECT page_id, {_html_sql('html')} AS text FROM pages")
def _(t):
    return t.pages.select("page_id", X.html_to_text("html").alias("text"))


@query("x01_html_to_text_exact", f"SELECT page_id, {_html_sql('html')} AS text FROM pages")
def _(t):
    return t.pages.select("page_id", K.html_to_text_exact("html").alias("text"))


def _inline_sql(col):
    s = f"regexp_replace({col}, '<[^>]+>', '', 'g')"
    for name, char in X.INLINE_ENTITIES:
        s = f"replace({s}, {lit(name)}, {lit(char)})"
    return STRIP(s)


@query("x02_strip_inline", f"SELECT page_id, {_inline_sql('html')} AS text FROM pages")
def _(t):
    return t.pages.select("page_id", X.strip_inline_tags("html").alias("text"))


# --- noise and quality -------------------------------------------------------------------------------
NOISE_CTE = rf"""ln AS (SELECT doc_id, i, line, {STRIP('line')} AS s FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
  ms AS (SELECT *, length(regexp_replace(s, '[^\p{{L}}]', '', 'g')) AS n, length(s) AS z FROM ln),
  kept AS (SELECT doc_id, i, CASE WHEN s = '' THEN '' ELSE line END AS line FROM ms WHERE s = '' OR NOT (regexp_matches(s, {lit(X.HEADER_TAG)})
    OR n = 0 OR (n < 3 AND z <= 10) OR regexp_matches(s, {lit(X.NUMBER_LINE)}) OR regexp_matches(s, {lit(X.TABLE_LINE)}) OR (z <= 30 AND n / CAST(z AS DOUBLE) < 0.20)))"""


@query("x03_remove_noise", f"""WITH {NOISE_CTE} SELECT d.doc_id, {STRIP("coalesce(k.t, '')")} AS text FROM documents d
  LEFT JOIN (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS t FROM kept GROUP BY 1) k USING (doc_id)""")
def _(t):
    return t.documents.select("doc_id", X.remove_noise("text", LATIN).alias("text"))


QUALITY = rf"""ln AS (SELECT doc_id, {STRIP('line')} AS s FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)),
  ag AS (SELECT doc_id, count(*) AS n, avg(length(s)) AS avg_len, count(*) FILTER (WHERE regexp_matches(s, {lit(X.NUMBER_LINE)}) OR (length(s) <= 10 AND NOT regexp_matches(s, '[\p{{L}}]'))) AS bad
    FROM ln WHERE s <> '' GROUP BY 1),
  qual AS (SELECT d.doc_id, length(regexp_replace(text, '[^\p{{L}}]', '', 'g')) / CAST(greatest(length(text), 1) AS DOUBLE) AS letter_ratio,
    length(regexp_replace(text, '[^\p{{Nd}}]', '', 'g')) / CAST(greatest(length(text), 1) AS DOUBLE) AS digit_ratio, length(text) AS length,
    coalesce(bad, 0) / CAST(greatest(coalesce(n, 0), 1) AS DOUBLE) AS noise_line_ratio, coalesce(avg_len, 0.0) AS avg_line_len FROM documents d LEFT JOIN ag USING (doc_id)),
  quality AS (SELECT *, letter_ratio * 0.4 + (1 - noise_line_ratio) * 0.3 + least(length / 1200.0, 1.0) * 0.3 AS score FROM qual)"""


def measured(t):
    return t.documents.select("doc_id", X.quality_measures("text", LATIN).alias("q")).select("doc_id", "q.*")


@query("x12_chunk_quality", f"""WITH {QUALITY} SELECT doc_id, round(letter_ratio, 6) AS letter_ratio, round(digit_ratio, 6) AS digit_ratio, length,
  round(noise_line_ratio, 6) AS noise_line_ratio, round(avg_line_len, 6) AS avg_line_len, round(score, 6) AS score FROM quality""")
def _(t):
    return r(measured(t))


@query("x12_quality_counts", f"""WITH {QUALITY} SELECT count(*) AS chunks, count(*) FILTER (WHERE letter_ratio < 0.3) AS few_letters, count(*) FILTER (WHERE length < 100) AS short,
  count(*) FILTER (WHERE noise_line_ratio > 0.3) AS noisy, count(*) FILTER (WHERE score >= 0.6) AS good FROM quality""")
def _(t):
    return K.quality_counts(measured(t))


@query("w15_worst_chunks", f"WITH {QUALITY} SELECT doc_id, round(score, 6) AS score FROM quality ORDER BY round(score, 6), doc_id LIMIT 5")
def _(t):
    return r(measured(t).select("doc_id", "score")).orderBy("score", "doc_id").limit(5)


# --- chunks ------------------------------------------------------------------------------------------
@query("x04_fixed_chunks", """SELECT doc_id, doc_id || '_' || lpad(CAST(i // 700 AS VARCHAR), 4, '0') AS chunk_id, CAST(i // 700 AS BIGINT) AS chunk_no, substr(text, i + 1, 800) AS content
  FROM (SELECT doc_id, text, unnest(range(0, length(text), 700)) AS i FROM documents)""")
def _(t):
    return K.fixed_chunk_table(t.documents, "doc_id", "text")


@query("x05_packed_chunks")
def _(t):
    chunks = X.packed_chunks("text", separator=r"\n")
    return t.documents.select("doc_id", F.posexplode(chunks).alias("chunk_no", "content"))


def pages_of(t):
    return K.split_pages(t.documents, "doc_id", "text")


@query("x06_chunk_table")
def _(t):
    return K.build_chunks(pages_of(t), "doc_id", LATIN, HEAD, separator=r"(?<=\.) ", size=400, overlap=60)


@query("x07_section_chunks")
def _(t):
    text = F.concat(F.lit("[["), "source", F.lit("]]\n"), "text", F.lit("\n\n[[note]]\n"), F.reverse("text"))
    return K.section_chunks(t.documents.select("doc_id", text.alias("body_text")), "doc_id", "body_text", {"src": "FILING"}, "NEWS")


_STEM = r"regexp_replace(regexp_replace(url, '^.*/', ''), '(.)\.[^.]*$', '\1')"


@query("x08_doc_slug", rf"SELECT page_id, lower(regexp_replace(regexp_replace({_STEM}, '[\s\-]+', '_', 'g'), '[^\p{{L}}\p{{N}}_]', '', 'g')) AS slug FROM pages")
def _(t):
    return t.pages.select("page_id", X.slug("url").alias("slug"))


@query("x08_valid_chunks", """SELECT chunk_id FROM (SELECT doc_id || '_' || lpad(CAST(i // 700 AS VARCHAR), 4, '0') AS chunk_id, substr(text, i + 1, 800) AS content
  FROM (SELECT doc_id, text, unnest(range(0, length(text), 700)) AS i FROM documents)) WHERE length(content) >= 50""")
def _(t):
    chunks = K.fixed_chunk_table(t.documents, "doc_id", "text")
    return chunks.where(X.is_valid_chunk(F.col("chunk_id"), F.col("content"))).select("chunk_id")


@query("x09_enriched_text", """SELECT doc_id, '제목: ' || source || chr(10) || '내용: ' || text || chr(10) || '키워드: ' || lang || ', ' || source AS enriched,
  CAST(to_json({'lang': lang, 'source': source}) AS VARCHAR) AS metadata FROM documents""")
def _(t):
    words = F.array("lang", "source")
    meta = F.to_json(F.map_from_arrays(F.array(F.lit("lang"), F.lit("source")), F.array("lang", "source")))
    return t.documents.select("doc_id", X.enriched_text(F.col("source"), F.col("text"), words).alias("enriched"), meta.alias("metadata"))


@query("x10_unnest_report", """SELECT 'summary_001' AS chunk_id, CAST(doc_id AS VARCHAR) AS doc_id, 'summary' AS section, source AS title, text, lang || ',' || source AS keywords FROM documents
  UNION ALL SELECT 'lines_' || lpad(CAST(i AS VARCHAR), 3, '0'), CAST(doc_id AS VARCHAR), 'lines', source, line, lang FROM (SELECT doc_id, source, lang, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)""")
def _(t):
    item = lambda title, text, words: F.struct(title.alias("title"), text.alias("text"), words.alias("keywords"))
    src, lang = F.col("source"), F.col("lang")
    sections = F.array(
        F.struct(F.lit("summary").alias("section"), F.array(item(src, F.col("text"), F.array(lang, src))).alias("items")),
        F.struct(F.lit("lines").alias("section"),
                 F.transform(F.split("text", "\n", -1), lambda l: item(src, l, F.array(lang))).alias("items")))
    raw = t.documents.select(F.to_json(F.struct(F.col("doc_id").cast("string").alias("doc_id"), sections.alias("sections"))).alias("json"))
    return K.unnest_report(raw, "json").withColumn("keywords", F.array_join("keywords", ","))


# --- sections and lines ------------------------------------------------------------------------------
_PAGES_SQL = """pg AS (SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS BIGINT) AS page_num, unnest(string_split(text, chr(10))) AS text FROM documents)"""


@query("w11_carry_section", f"""WITH {_PAGES_SQL} SELECT doc_id, page_num, coalesce(last_value(CASE WHEN regexp_matches({STRIP('text')}, {lit(HEAD)}) THEN {STRIP('text')} END IGNORE NULLS)
  OVER (PARTITION BY doc_id ORDER BY page_num ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'General') AS section FROM pg""")
def _(t):
    return K.with_sections(pages_of(t), "doc_id", HEAD).select("doc_id", "page_num", "section")


@query("w12_number_rows", "SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS seq FROM documents")
def _(t):
    return number_rows(t.documents.select("source", "doc_id"), ["source"], "doc_id", "seq")


def _context_sql(cond):
    return rf"""WITH ln AS (SELECT source, doc_id, i, {STRIP('line')} AS s FROM (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS line,
      generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
    k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, i) AS rk FROM ln WHERE regexp_matches(s, '[\p{{L}}]') {cond})
    SELECT source, string_agg(s, chr(10) ORDER BY rk) AS context, count(*) AS n_lines FROM k WHERE rk <= 60 GROUP BY 1"""


@query("x11_context_lines", _context_sql(""))
def _(t):
    return K.context_lines(t.documents, "source", "doc_id", "text", LATIN)


@query("x11_context_named", _context_sql("AND (contains(s, 'there') OR contains(s, 'und '))"))
def _(t):
    return K.context_lines(t.documents, "source", "doc_id", "text", LATIN, F.array(F.lit("there"), F.lit("und ")))


WORDS = (r"\p{Lu}\p{L}{2,}", r"\d+[.\d]*%", r"\p{L}{2,}er", r"\p{L}{9,}")
_KW = lambda col: "list_distinct(flatten([" + ", ".join(f"regexp_extract_all({col}, {lit(p)})" for p in WORDS) + "]))"


@query("x13_keyword_recall", f"""SELECT a.conv_id, a.turn, len({_KW('a.text')}) AS gt_keywords, len(list_intersect({_KW('a.text')}, {_KW('b.text')})) AS matched_keywords,
  round(len(list_intersect({_KW('a.text')}, {_KW('b.text')})) / CAST(greatest(len({_KW('a.text')}), 1) AS DOUBLE), 6) AS keyword_recall
  FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1""")
def _(t):
    kw = t.conversations.select("conv_id", "turn", X.keyword_set("text", WORDS).alias("kw"))
    ctx = kw.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("kw").alias("ctx"))
    both = kw.join(ctx, ["conv_id", "turn"])
    return r(both.select(
        "conv_id", "turn", F.size("kw").cast("bigint").alias("gt_keywords"),
        F.size(F.array_intersect("kw", "ctx")).cast("bigint").alias("matched_keywords"),
        X.keyword_recall(F.col("kw"), F.col("ctx")).alias("keyword_recall")))


# --- labels and questions ----------------------------------------------------------------------------
_WORDS = [w for w, _ in K.REPORT_LABELS]
_TITLE_SQL = f"source || ' ' || ([{', '.join(lit(w) for w in _WORDS)}, '기타'])[1 + doc_id % 30] || ' ' || ([{', '.join(lit(w) for w in _WORDS)}, '기타'])[1 + (doc_id // 30) % 30]"
_LABEL_SQL = "CASE " + " ".join(f"WHEN contains(nm, {lit(w)}) THEN {lit(lb)}" for w, lb in K.REPORT_LABELS) + " END"


@query("b18_report_label", f"SELECT doc_id, nm AS report_nm, {_LABEL_SQL} AS label FROM (SELECT doc_id, {_TITLE_SQL} AS nm FROM documents)")
def _(t):
    words = F.array(*[F.lit(w) for w in (*_WORDS, "기타")])
    at = lambda i: F.element_at(words, (1 + i % 30).cast("int"))
    title = F.concat_ws(" ", "source", at(F.col("doc_id")), at(F.floor(F.col("doc_id") / 30)))
    return K.label_reports(t.documents.select("doc_id", title.alias("report_nm")))


@query("b19_keyword_filter", "SELECT doc_id FROM documents WHERE contains(text, 'there') OR contains(text, '(c)') OR contains(text, 'und.')")
def _(t):
    return t.documents.where(any_keyword(F.col("text"), ["there", "(c)", "und."])).select("doc_id")


_METRIC_WORDS = [w for ws, _ in Qn.USAGE_WORDS for w in ws]


def asked(t):
    """User turns with district names, years, metric words and cluster numbers worked in."""
    k = F.col("conv_id")
    pick = lambda items, i: F.element_at(F.array(*[F.lit(x) for x in items]), (1 + i % len(items)).cast("int"))
    d1, d2 = pick(Qn.DISTRICTS, k), pick(Qn.DISTRICTS, k + 7)
    word, year = pick(_METRIC_WORDS, k), F.concat((F.lit(1995) + k % 30).cast("string"), F.lit("년"))
    extra = (
        F.when(k % 5 == 0, F.concat(F.lit("서울 "), word)).when(k % 5 == 1, F.concat(d1, F.lit(" "), word, F.lit(" 추이")))
        .when(k % 5 == 2, F.concat(d1, F.lit(" "), d2, F.lit(" "), d1))
        .when(k % 5 == 3, F.concat(F.lit("군집 "), (k % 9).cast("string"), F.lit(" 목록"))).otherwise(F.concat(d1, F.lit(" 어떤 곳")))
    )
    return t.conversations.where("role = 'user'").select("conv_id", "turn", F.concat("text", F.lit(" "), year, F.lit(" "), extra).alias("question"))


_ARR = lambda items, i: f"([{', '.join(lit(x) for x in items)}])[1 + ({i}) % {len(items)}]"
_D1, _D2, _WD = _ARR(Qn.DISTRICTS, "conv_id"), _ARR(Qn.DISTRICTS, "conv_id + 7"), _ARR(_METRIC_WORDS, "conv_id")
ASKED = rf"""asked AS (SELECT conv_id, turn, text || ' ' || (1995 + conv_id % 30) || '년 ' || CASE conv_id % 5 WHEN 0 THEN '서울 ' || {_WD} WHEN 1 THEN {_D1} || ' ' || {_WD} || ' 추이'
    WHEN 2 THEN {_D1} || ' ' || {_D2} || ' ' || {_D1} WHEN 3 THEN '군집 ' || (conv_id % 9) || ' 목록' ELSE {_D1} || ' 어떤 곳' END AS question FROM conversations WHERE role = 'user'),
  tagged AS (SELECT *, list_filter(list_distinct_ordered, lambda d: list_contains([{', '.join(lit(d) for d in Qn.DISTRICTS)}], d)) AS districts,
    TRY_CAST(nullif(regexp_extract(question, '(20\d{{2}})년?', 1), '') AS INTEGER) AS year, TRY_CAST(nullif(regexp_extract(question, '(?i)(?:클러스터|cluster|군집|집단)\s*(\d+)', 1), '') AS INTEGER) AS cluster_id,
    CASE {' '.join('WHEN ' + ' OR '.join(f"contains(question, {lit(w)})" for w in ws) + f' THEN {lit(key)}' for ws, key in Qn.USAGE_WORDS)} ELSE 'total_usage' END AS metric
    FROM (SELECT *, list_transform(list_filter(list_zip(f, range(1, len(f) + 1)), lambda p: list_position(f, p[1]) = p[2]), lambda p: p[1]) AS list_distinct_ordered
      FROM (SELECT *, regexp_extract_all(question, '([가-힣]{{2,}}구)', 1) AS f FROM asked)))"""


@query("b20_question_tags", f"WITH {ASKED} SELECT conv_id, turn, array_to_string(districts, ',') AS districts, districts[1] AS district, year, metric, cluster_id FROM tagged")
def _(t):
    rows = asked(t).select("conv_id", "turn", Qn.tag(F.col("question")).alias("g")).select("conv_id", "turn", "g.*")
    return rows.withColumn("districts", F.array_join("districts", ","))


_ANY = lambda ws: "(" + " OR ".join(f"contains(question, {lit(w)})" for w in ws) + ")"


@query("b21_question_route", f"""WITH {ASKED} SELECT conv_id, turn, CASE WHEN contains(question, '서울') AND len(districts) = 0 THEN 'overview' WHEN len(districts) >= 2 THEN 'compare'
  WHEN cluster_id IS NOT NULL AND {_ANY(Qn.LIST_WORDS)} THEN 'cluster_list' WHEN len(districts) = 1 AND {_ANY(Qn.TREND_WORDS)} THEN 'trend'
  WHEN len(districts) = 1 THEN 'cluster' ELSE 'general' END AS route FROM tagged""")
def _(t):
    rows = asked(t).withColumn("g", Qn.tag(F.col("question")))
    return rows.select("conv_id", "turn", Qn.route(F.col("question"), F.col("g")).alias("route"))


# --- the same over the supply panel: any district but the stop words, its own metric and trend words -----------------
def asked_supply(t):
    """Questions with a word that only looks like a district, and a metric word of the supply panel."""
    words = [w for ws, _ in Qn.SUPPLY_WORDS for w in ws]
    word = F.element_at(F.array(*[F.lit(x) for x in words]), (1 + (F.col("conv_id") + F.col("turn")) % len(words)).cast("int"))
    return asked(t).withColumn("question", F.concat("question", F.lit(" 수급가구 "), word, F.lit(" 집단 4")))


_SUPPLY_WORD = _ARR([w for ws, _ in Qn.SUPPLY_WORDS for w in ws], "conv_id + turn")
_SUPPLY_ASKED = rf"""{ASKED}, sq AS (SELECT conv_id, turn, question || ' 수급가구 ' || {_SUPPLY_WORD} || ' 집단 4' AS question FROM asked),
  st AS (SELECT *, TRY_CAST(nullif(regexp_extract(question, '(20\d{{2}})년?', 1), '') AS INTEGER) AS year, TRY_CAST(nullif(regexp_extract(question, '(?i)(?:클러스터|cluster|군집)\s*(\d+)', 1), '') AS INTEGER) AS cluster_id,
    list_filter(list_transform(list_filter(list_zip(f, range(1, len(f) + 1)), lambda p: list_position(f, p[1]) = p[2]), lambda p: p[1]), lambda d: NOT list_contains([{', '.join(lit(d) for d in Qn.NOT_DISTRICTS)}], d)) AS districts,
    CASE {' '.join('WHEN ' + ' OR '.join(f"contains(question, {lit(w)})" for w in ws) + f' THEN {lit(key)}' for ws, key in Qn.SUPPLY_WORDS)} ELSE 'gas_supply' END AS metric
    FROM (SELECT *, regexp_extract_all(question, '([가-힣]{{2,}}구)', 1) AS f FROM sq))"""


def _supply_tag():
    return Qn.tag(F.col("question"), None, Qn.SUPPLY_WORDS, "gas_supply", Qn.SUPPLY_CLUSTER_PATTERN)


@query("b20_supply_tags", f"WITH {_SUPPLY_ASKED} SELECT conv_id, turn, array_to_string(districts, ',') AS districts, districts[1] AS district, year, metric, cluster_id FROM st")
def _(t):
    rows = asked_supply(t).select("conv_id", "turn", _supply_tag().alias("g")).select("conv_id", "turn", "g.*")
    return rows.withColumn("districts", F.array_join("districts", ","))


@query("b21_supply_route", f"""WITH {_SUPPLY_ASKED} SELECT conv_id, turn, CASE WHEN contains(question, '서울') AND len(districts) = 0 THEN 'overview' WHEN len(districts) >= 2 THEN 'compare'
  WHEN cluster_id IS NOT NULL AND {_ANY(Qn.LIST_WORDS)} THEN 'cluster_list' WHEN len(districts) = 1 AND {_ANY(Qn.SUPPLY_TREND_WORDS)} THEN 'trend'
  WHEN len(districts) = 1 THEN 'cluster' ELSE 'general' END AS route FROM st""")
def _(t):
    rows = asked_supply(t).withColumn("g", _supply_tag())
    return rows.select("conv_id", "turn", Qn.route(F.col("question"), F.col("g"), trend_words=Qn.SUPPLY_TREND_WORDS).alias("route"))


@query("x11_context_fallback", f"""WITH found AS ({_context_sql("AND contains(s, 'und ')")}) SELECT d.source, coalesce(context, '자료 없음') AS context, coalesce(n_lines, 0) AS n_lines
  FROM (SELECT DISTINCT source FROM documents) d LEFT JOIN found USING (source)""")
def _(t):
    return K.context_lines(t.documents, "source", "doc_id", "text", LATIN, F.array(F.lit("und ")), fallback="자료 없음")
