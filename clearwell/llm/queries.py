"""The registered queries of this subpackage, with SQL where it can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.llm import (
    decontamination,
    exact_duplicates,
    language,
    licences,
    mixing,
    near_duplicates,
    pages,
    periodic_runs,
    token_counts,
    topk,
    toxicity,
    training_order,
    whitening,
)
from clearwell.llm.common import WORD, fold, let_workers_import


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
    ('0x' || substr(md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 6))::BIGINT AS draw
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS total, 2.0::DOUBLE * sum(size)::DOUBLE AS cap,
    [3.0::DOUBLE, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(total::DOUBLE) OVER ()
    - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM totals),
targets AS (
  SELECT source, total, CASE WHEN level * w >= cap THEN cap
    ELSE max(CASE WHEN level * w < cap THEN level END) OVER () * w END AS target FROM levels),
rests AS (
  SELECT *, CASE WHEN total = 0 THEN 0 ELSE CAST(floor(target / total) AS BIGINT) END AS whole FROM targets),
draws AS (SELECT source, draw, sum(size) AS words FROM sized GROUP BY ALL),
running AS (
  SELECT source, draw, sum(words) OVER (PARTITION BY source ORDER BY draw) AS upto,
    coalesce(lag(draw) OVER (PARTITION BY source ORDER BY draw), -1) AS prior,
    sum(words) OVER (PARTITION BY source ORDER BY draw) - words AS below FROM draws),
cuts AS (
  SELECT r.source, arg_min(CASE WHEN upto - (target - whole * total) < (target - whole * total) - below
      THEN draw ELSE prior END, draw) AS cut
  FROM running r JOIN rests t ON r.source IS NOT DISTINCT FROM t.source
  WHERE target - whole * total > 0 AND upto >= target - whole * total GROUP BY r.source)
SELECT s.doc_id, s.size, t.total AS source_size, t.target,
  s.size * (t.whole + CASE WHEN s.draw <= c.cut THEN 1 ELSE 0 END) AS taken
FROM sized s JOIN rests t ON s.source IS NOT DISTINCT FROM t.source
LEFT JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source
""")
def op1_mix(spark, folder):
    sized = mixing.sized_documents(table(spark, folder, "documents"), seed=42)
    mixed = mixing.mixed_sizes(sized, mixing.plan_mix(sized.drop("key"), cycle=(3, 1, 2), share=1.5, max_epochs=2.0))
    return mixed.select(
        F.col("key").alias("doc_id"), "size", F.col("total").alias("source_size"), "target", "taken"
    )


@query()
def op3_language(spark, folder):
    documents = table(spark, folder, "documents")
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(True))
    model = language.fit(documents.where(~held_out))
    found = documents.select(
        "doc_id", held_out.alias("held_out"), language.predict(spark, model, F.col("text")).alias("found")
    )
    return found.select("doc_id", "held_out", "found.*")


@query()
def op5_token_counts(spark, folder):
    return token_counts.token_counts(table(spark, folder, "documents"), file="byte_bpe_50k.json", limit=512)


@query()
def op10_near_duplicates(spark, folder):
    return near_duplicates.near_duplicates(table(spark, folder, "documents"), width=2, percent=80)


@query()
def op2_training_order(spark, folder):
    return training_order.training_order(table(spark, folder, "documents"), seed=42, length=512)


@query()
def op4_decontaminate(spark, folder):
    documents, benchmark = (table(spark, folder, name) for name in ("documents", "benchmark"))
    return decontamination.contaminated(documents, benchmark, similarity=0.8, recall=0.95).drop("text")


@query()
def op6_toxicity(spark, folder):
    documents, labels = (table(spark, folder, name) for name in ("documents", "labels"))
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(True))
    model = toxicity.fit(documents.where(~held_out), labels.where(~held_out))
    scored = documents.select(
        "doc_id", held_out.alias("held_out"), toxicity.score(spark, model, F.col("text")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _canonical_sql(text: str) -> str:
    """The canonical form of a licence text in SQL."""
    out = f"regexp_replace(lower(coalesce({text}, '')), '{licences.COPYRIGHT_LINE}', '\\1', 'g')"
    out = f"' ' || replace(trim(regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ', '  ') || ' '"
    for pair in licences.SPELLINGS:
        other, one = (f" {s.replace(' ', '  ')} " for s in pair)
        out = f"replace({out}, '{other}', '{one}')"
    return f"trim(replace({out}, '  ', ' '))"


_KNOWN_SQL = ", ".join(f"('{name}', '{text.replace(chr(39), chr(39) * 2)}')" for name, text in licences.KNOWN)


@query(f"""
WITH known AS (
  SELECT sha256({_canonical_sql("body")}) AS digest, min(name) AS licence
  FROM (VALUES {_KNOWN_SQL}) AS t(name, body) GROUP BY 1),
whole AS (SELECT doc_id, {_canonical_sql("text")} AS form FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
hits AS (
  SELECT DISTINCT doc_id, digest, licence
  FROM (SELECT doc_id, sha256({_canonical_sql("line")}) AS digest FROM lines
        WHERE regexp_matches(line, '[a-zA-Z]{{2}}')) JOIN known USING (digest)),
found AS (
  SELECT doc_id, count(*) AS n, array_to_string(list_sort(list(DISTINCT licence)), ',') AS notices
  FROM hits GROUP BY doc_id)
SELECT w.doc_id, CASE WHEN form <> '' THEN sha256(form) END AS digest, k.licence,
  coalesce(n, 0) AS n_notices, coalesce(notices, '') AS notices
FROM whole w LEFT JOIN known k ON k.digest = CASE WHEN form <> '' THEN sha256(form) END
LEFT JOIN found f ON w.doc_id IS NOT DISTINCT FROM f.doc_id
""")
def op7_licences(spark, folder):
    return licences.licences(table(spark, folder, "documents"))


@query("""
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON len(q.v) = len(c.v) AND q.r <> c.r WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INT) AS rank,
    vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 5
""")
def op8_top_k(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return topk.top_k(vectors, is_query=F.col("vec_id") % 50 == 0, k=5)


@query()
def op9_main_text(spark, folder):
    return pages.extract(table(spark, folder, "pages"))


@query("""
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS content
  FROM documents),
groups AS (SELECT content, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY content)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.content) AS text_sha256
FROM texts t JOIN groups g USING (content)
""")
def op12_exact_duplicates(spark, folder):
    found = exact_duplicates.exact_duplicates(table(spark, folder, "documents"))
    return found.withColumn("digest", F.lower(F.hex("digest"))).withColumnRenamed("digest", "text_sha256")


def _with_planted_periods(documents: DataFrame) -> DataFrame:
    """``doc_id, text``: in a tenth of the documents, by their id, the words from one on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    planted = documents.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    repeated = F.expr("""
        concat_ws(' ', transform(words, (word, i) -> if(i < a, word,
            words[cast(a + (i - a) % (1 + (n - a) div (3 + g % 8)) as int)])))
    """)
    chosen = (
        planted.where("h % 10 = 0 AND text IS NOT NULL").withColumn("words", words)
        .withColumn("n", F.size("words")).withColumn("a", F.expr("g % greatest(n, 1)"))
    )
    rest = planted.where("h IS NULL OR h % 10 <> 0 OR text IS NULL").select("doc_id", "text")
    return rest.unionByName(chosen.select("doc_id", repeated.alias("text")))


@query()
def op13_periodic_runs(spark, folder):
    found = periodic_runs.periodic_runs(_with_planted_periods(table(spark, folder, "documents")))
    # The longest run: of equal lengths the first to start, then the one with the smallest period.
    longest = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start AS start, -r.period AS period)))")
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    found = found.withColumn("best", longest)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), "best.length",
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query()
def op11_whiten(spark, folder):
    whitened = whitening.whiten(table(spark, folder, "embeddings"), components=32)
    return whitened.withColumn("deviation", F.col("deviation").cast("long"))
