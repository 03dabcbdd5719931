"""The operators as queries on the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores, text
from ..functions.keyed import dense_ids, renamed, u
from ..operators import aggregate, assemble, evolve, lineage, merge, neighbours, providers, select
from ..sources import checkpoints, json_io
from ..sources.tables import materialize, scratch, spread, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: The keyed uniform of functions.keyed.u, in SQL.
_MACROS = {"U": "(('0x' || substr(md5(concat_ws('|', {})), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"}


def _u(*parts: str) -> str:
    return _MACROS["U"].format(", ".join(f"({p})::VARCHAR" for p in parts))


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _again(df: DataFrame, key: str, older: dict[str, Column], newer: dict[str, Column]) -> DataFrame:
    """The rows with a position, and before every third and after every seventh of them another of the same key."""
    one = lambda step, pos, fields: df.filter(F.pmod(key, F.lit(step)) == 0).withColumns(fields).withColumn("pos", F.lit(pos))
    return one(1, 0, {}).unionByName(one(3, -1, older)).unionByName(one(7, 1, newer))


def _again_sql(source: str, key: str, **fields: tuple[str, str, str]) -> str:
    """What is left of such rows if the last of each key wins; fields as (own, older, newer)."""
    one = lambda step, pos, i: f"SELECT {key}, {', '.join(f'{v[i]} AS {n}' for n, v in fields.items())}, {pos} AS pos FROM {source} WHERE {key} % {step} = 0"
    return f"(SELECT * EXCLUDE (pos) FROM ({one(1, 0, 0)} UNION ALL {one(3, -1, 1)} UNION ALL {one(7, 1, 2)}) QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY pos DESC) = 1)"


def _r(c, digits: int = 6):
    return F.round(c, digits)


@query(r"""SELECT page_id, trim(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)) AS title, trim(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)) AS h1 FROM pages""")
def q01_tag_extract(spark, d):
    return table(spark, d, "pages").select("page_id", text.tag_text(F.col("html"), "title").alias("title"), text.tag_text(F.col("html"), "h1").alias("h1"))


@query(r"""SELECT doc_id, md5(regexp_replace("text", '^\s+|\s+$', '', 'g')) AS answer_md5 FROM documents""")
def q02_tag_default_full(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(text.tag_text(F.col("text"), "answer", default=None)).alias("answer_md5"))


@query(r"""WITH l AS (SELECT doc_id, list_transform(list_filter(list_transform(string_split("text", chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '' AND x <> '-'), lambda x: regexp_replace(x, '^[- ]+', '')) AS b FROM documents)
SELECT doc_id, unnest(range(len(b)))::INT AS pos, md5(unnest(b)) AS bullet_md5 FROM l""")
def q03_bullets(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.posexplode(text.bullets(F.col("text"))).alias("pos", "bullet"))
    return rows.select("doc_id", "pos", F.md5("bullet").alias("bullet_md5"))


@query(r"""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split("text", chr(10)), lambda x: regexp_replace(regexp_replace(x, '^\s+|\s+$', '', 'g'), '^[-\d.\s]+', '')), lambda x: x <> '' AND NOT starts_with(x, '#') AND NOT starts_with(x, '(')) AS b FROM documents)
SELECT doc_id, len(b)::INT AS n, md5(array_to_string(b, chr(10))) AS bullets_md5 FROM l""")
def q03b_numbered_bullets(spark, d):
    rows = table(spark, d, "documents").select("doc_id", text.numbered_bullets(F.col("text")).alias("b"))
    return rows.select("doc_id", F.size("b").alias("n"), F.md5(F.array_join("b", "\n")).alias("bullets_md5"))


@query(r"""SELECT event_id, 'k: ' || json_extract_string(props, '$.k') AS block, '"k": "' || json_extract_string(props, '$.k') || '"' AS quoted FROM events""")
def q04_options_block(spark, d):
    rows = table(spark, d, "events").withColumn("m", text.parsed_options(F.col("props")))
    return rows.select("event_id", text.options_block(F.col("m")).alias("block"), text.options_block(F.col("m"), quoted=True).alias("quoted"))


def _overlaid(spark, d):
    labels = table(spark, d, "labels").select("doc_id", F.concat(F.lit("quality "), F.col("quality")).alias("label"))
    labels = _again(labels, "doc_id", {"label": F.lit("older")}, {"label": F.lit("newer")})
    return merge.replaced(table(spark, d, "documents").select("doc_id", "lang", "source"), labels, "doc_id", "lang", "label")


_OVERLAID = f"""SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL AND d.lang IS NOT NULL THEN l.label ELSE d.lang END AS lang, d.source, l.doc_id IS NOT NULL AS matched, l.doc_id IS NOT NULL AND d.lang IS NOT NULL AS replaced FROM documents d LEFT JOIN {_again_sql("labels", "doc_id", label=("'quality ' || quality", "'older'", "'newer'"))} l USING (doc_id)"""


@query(_OVERLAID)
def q05_left_overlay(spark, d):
    return _overlaid(spark, d)


@query("""WITH c AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS new_id FROM labels WHERE quality = 1 - toxic)
SELECT d.doc_id, d.source, c.new_id FROM documents d JOIN c USING (doc_id)""")
def q06_correct_reindex(spark, d):
    labels = table(spark, d, "labels").select("doc_id", F.concat(F.lit(" "), F.col("quality")).alias("answer"), (1 - F.col("toxic")).cast("string").alias("truth"), F.col("doc_id").alias("pos"))
    right = merge.correct_rows(labels, "answer", "truth", "doc_id")
    return merge.reindexed(right, table(spark, d, "documents").select("doc_id", "source"), "doc_id")


@query("SELECT doc_id AS id, lang AS language, source AS origin, n_chars AS length FROM documents")
def q07_project_rename(spark, d):
    return renamed(table(spark, d, "documents"), {"doc_id": "id", "lang": "language", "source": "origin", "n_chars": "length", "absent": "nothing"})


@query(f"SELECT d.doc_id, d.source, coalesce(l.q, '') AS question_type, coalesce(l.t, '') AS knowledge_point FROM documents d LEFT JOIN {_again_sql('labels', 'doc_id', q=('quality::VARCHAR', chr(39) + 'older' + chr(39), 'NULL'), t=('toxic::VARCHAR', 'toxic::VARCHAR', chr(39) + 'newer' + chr(39)))} l USING (doc_id)")
def q08_default_merge(spark, d):
    right = table(spark, d, "labels").select("doc_id", F.col("quality").cast("string").alias("question_type"), F.col("toxic").cast("string").alias("knowledge_point"))
    right = _again(right, "doc_id", {"question_type": F.lit("older")}, {"question_type": F.lit(None).cast("string"), "knowledge_point": F.lit("newer")})
    return merge.with_defaults(table(spark, d, "documents").select("doc_id", "source"), right, "doc_id", ("question_type", "knowledge_point"))


@query("""WITH t AS (SELECT CASE WHEN lang = 'en' THEN 'Others' ELSE lang END AS a, CASE WHEN source = 'src0' THEN 'Others' ELSE source END AS b FROM documents)
SELECT coalesce(a, '') AS question_type, coalesce(b, '') AS knowledge_point, count(*) AS n, (coalesce(a, '') = 'Others') <> (coalesce(b, '') = 'Others') AS one_other FROM t GROUP BY ALL""")
def q09_combo_counts(spark, d):
    rows = table(spark, d, "documents").select(F.when(F.col("lang") == "en", "Others").otherwise(F.col("lang")).alias("question_type"), F.when(F.col("source") == "src0", "Others").otherwise(F.col("source")).alias("knowledge_point"))
    return aggregate.tag_counts(rows).withColumn("one_other", select.one_other("question_type", "knowledge_point"))


_SPLIT = """SELECT o_orderkey, (o_orderstatus = 'P') <> (o_orderpriority = '5-LOW') AS others FROM orders"""


def _split_orders(spark, d):
    tag = lambda c, v: F.when(F.col(c) == v, "Others").otherwise(F.col(c)).alias(c)
    rows = table(spark, d, "orders").select("o_orderkey", tag("o_orderstatus", "P"), tag("o_orderpriority", "5-LOW"))
    return rows.select("o_orderkey", select.one_other("o_orderstatus", "o_orderpriority").alias("others"))


@query(f"""WITH s AS ({_SPLIT}) SELECT o_orderkey, others, row_number() OVER (PARTITION BY others ORDER BY o_orderkey) - 1 AS new_id FROM s""")
def q10_split_renumber(spark, d):
    return dense_ids(_split_orders(spark, d), "o_orderkey", "new_id", by=("others",))


@query(f"""WITH s AS ({_SPLIT}) SELECT o_orderkey, CASE WHEN others THEN 'others' ELSE 'classes' END AS file, row_number() OVER (PARTITION BY others ORDER BY o_orderkey) - 1 AS new_id FROM s""")
def q11_id_map(spark, d):
    return dense_ids(_split_orders(spark, d), "o_orderkey", "new_id", by=("others",)).select("o_orderkey", F.when(F.col("others"), "others").otherwise("classes").alias("file"), "new_id")


@query("""SELECT p_brand, p_type, (row_number() OVER (ORDER BY min(p_partkey)) - 1)::INT AS island_id, count(*) AS size FROM part GROUP BY 1, 2""")
def q12_islands(spark, d):
    return aggregate.islands(table(spark, d, "part"), "p_brand", "p_type", "p_partkey")


_FITNESS = f"""SELECT p_partkey, p_type, (0.4::DOUBLE / (1 + 0.2::DOUBLE * (p_size % 5)) + 0.4::DOUBLE * least(1.0::DOUBLE, 0.5::DOUBLE + 0.1::DOUBLE * (p_size % 7)) + 0.2::DOUBLE * (0.8::DOUBLE + 0.4::DOUBLE * {_u("'7'", "'fitness'", "'1'", "p_partkey")}))
  * CASE WHEN p_size % 2 = 0 THEN 1.1::DOUBLE ELSE 1.0::DOUBLE END AS fitness FROM part"""


def _rules(spark, d):
    size = F.col("p_size")
    return table(spark, d, "part").select("p_partkey", "p_type", scores.fitness(size % 5, size % 7, size % 2 == 0, u(7, "fitness", 1, F.col("p_partkey"))).alias("fitness"))


@query(f"SELECT p_partkey, round(fitness, 6) AS fitness FROM ({_FITNESS})")
def q13_fitness(spark, d):
    return _rules(spark, d).select("p_partkey", _r("fitness").alias("fitness"))


@query(f"""SELECT p_partkey, p_type, round(fitness, 6) AS fitness FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY round(fitness, 9) DESC, p_partkey) AS nth, count(*) OVER (PARTITION BY p_type) AS n FROM ({_FITNESS})) WHERE nth <= greatest(1, floor(n * 0.1::DOUBLE)::INT)""")
def q14_elites(spark, d):
    rows = _rules(spark, d).withColumn("fitness", _r("fitness", 9))
    return evolve.elites(rows, 0.1, "p_type", "fitness", "p_partkey").select("p_partkey", "p_type", _r("fitness").alias("fitness"))


def _picked(tasks: str, candidates: str, group: str, slot: str, key: str, *purpose: str) -> str:
    """SQL of one parent a task, from tasks (group, slot) and candidates (group, key, used)."""
    return f"""(WITH c AS (SELECT {group} AS g, {key} AS k, used, 720720 // (used + 1) AS w FROM {candidates}),
    h AS (SELECT *, sum(w) OVER (PARTITION BY g ORDER BY k)::BIGINT AS hi FROM c), f AS (SELECT g, k, row_number() OVER (PARTITION BY g ORDER BY k) - 1 AS at FROM c WHERE used = 0),
    z AS (SELECT g, count(*) FILTER (used = 0) AS fresh, sum(w)::BIGINT AS mass FROM c GROUP BY 1),
    t AS (SELECT {group} AS g, {slot} AS s, fresh, mass, {_u(*purpose, "'branch'", group, slot)} < 0.4 AND fresh > 0 AS even, {_u(*purpose, "'draw'", group, slot)} AS d FROM {tasks} JOIN z ON z.g = {group})
    SELECT t.g AS {group}, t.s AS {slot}, f.k AS {key} FROM t JOIN f ON f.g = t.g AND f.at = floor(d * fresh) WHERE even
    UNION ALL SELECT t.g, t.s, h.k FROM t JOIN h ON h.g = t.g AND floor(d * mass) >= h.hi - h.w AND floor(d * mass) < h.hi WHERE NOT even)"""


@query(f"""WITH c AS (SELECT c_custkey, c_nationkey, count(o_orderkey) AS used FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2),
n AS (SELECT DISTINCT c_nationkey, slot::BIGINT AS slot FROM customer, range(1, 41) t(slot)) SELECT * FROM {_picked("n", "c", "c_nationkey", "slot", "c_custkey", "'7'")}""")
def q15_parent_pick(spark, d):
    """Forty parents for each nation, as the evolution draws them."""
    orders = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("used"))
    rows = table(spark, d, "customer").select("c_custkey", "c_nationkey").join(orders, "c_custkey", "left").withColumn("used", F.coalesce("used", F.lit(0)))
    tasks = rows.select("c_nationkey").distinct().withColumn("slot", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(40).cast("long"))))
    return evolve.pick_parents(tasks, rows, "c_nationkey", "slot", "c_custkey", "used", 7)


_PLACED = "SELECT p_partkey AS id, dense_rank() OVER (ORDER BY f) - 1 AS island_id FROM (SELECT p_partkey, min(p_partkey) OVER (PARTITION BY p_type) AS f FROM part)"


@query(f"""WITH p AS ({_PLACED}), s AS (SELECT island_id, count(*) AS n FROM p GROUP BY 1), k AS (SELECT count(*) AS k, greatest(1, floor(min_by(n, island_id) * 0.05::DOUBLE)::INT) AS m FROM s),
t AS (SELECT island_id, m, k, CASE WHEN k > 1 THEN floor({_u("'7'", "'target'", "'3'", "island_id")} * (k - 1))::INT END AS spot FROM s, k),
g AS (SELECT island_id, m, CASE WHEN spot IS NULL THEN island_id WHEN spot < island_id THEN spot ELSE spot + 1 END AS target FROM t),
r AS (SELECT p.id, p.island_id, m, target, row_number() OVER (PARTITION BY p.island_id ORDER BY {_u("'7'", "'migrate'", "'3'", "p.id")}, p.id) AS nth FROM p JOIN g USING (island_id))
SELECT id, (CASE WHEN nth <= m THEN target ELSE island_id END)::INT AS island_id FROM r""")
def q16_migration(spark, d):
    part = table(spark, d, "part")
    tags = aggregate.islands(part.withColumn("one", F.lit("")), "p_type", "one", "p_partkey")
    rows = evolve.routed(part.select(F.col("p_partkey").alias("id"), "p_type", F.lit("").alias("one"), F.lit(0).alias("island_id")), tags, "p_type", "one")
    return evolve.migrated(rows.select("id", "island_id"), 7, 3)


_LINES = r"""SELECT doc_id, list_transform(list_filter(list_transform(string_split("text", chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '' AND x <> '-'), lambda x: regexp_replace(x, '^[- ]+', '')) AS b FROM documents"""


def _bulleted(spark, d):
    return table(spark, d, "documents").select("doc_id", text.bullets(F.col("text")).alias("b"))


@query(f"""WITH l AS ({_LINES}), p AS (SELECT x.doc_id AS id, list_concat(x.b, y.b) AS b FROM l x JOIN l y ON y.doc_id = x.doc_id + 1),
i AS (SELECT id, unnest(range(len(b)))::INT AS i, unnest(b) AS x FROM p), f AS (SELECT id, x, min(i) AS i FROM i GROUP BY 1, 2),
n AS (SELECT id, x, row_number() OVER (PARTITION BY id ORDER BY i) - 1 AS i FROM f), k AS (SELECT * FROM n WHERE {_u("'7'", "'bullet'", "'1'", "id", "i")} < 0.7)
SELECT p.id, 1 + count(k.x) AS n, md5('Combined rule' || coalesce(string_agg(chr(10) || k.x, '' ORDER BY k.i), '')) AS rule_md5 FROM p LEFT JOIN k USING (id) GROUP BY 1""")
def q17_crossover_sim(spark, d):
    rows = _bulleted(spark, d)
    other = rows.select((F.col("doc_id") - 1).alias("doc_id"), F.col("b").alias("c"))
    child = rows.join(other, "doc_id").select(F.col("doc_id").alias("id"), evolve.crossed_bullets(F.col("b"), F.col("c"), 0.7, 7, "bullet", 1, F.col("doc_id")).alias("r"))
    return child.select("id", F.size("r").cast("long").alias("n"), F.md5(F.array_join("r", "\n")).alias("rule_md5"))


@query(f"""WITH l AS ({_LINES}), k AS (SELECT doc_id, b, {_u("'7'", "'mutate'", "'1'", "doc_id")} < 0.15 AS mutated, CASE WHEN {_u("'7'", "'1'", "doc_id", "'kind'")} < 0.6 THEN 'adjusted' WHEN {_u("'7'", "'1'", "doc_id", "'kind'")} < 0.9 THEN 'reworked' ELSE 'inverted' END AS kind,
  floor({_u("'7'", "'1'", "doc_id", "'slot'")} * len(b))::INT AS spot, {_u("'7'", "'1'", "doc_id", "'edit'")} < 0.7 AND len(b) > 0 AS edit FROM l)
SELECT doc_id, mutated, md5(array_to_string(CASE WHEN NOT mutated THEN b WHEN edit THEN list_concat(list_concat(b[1:spot], [b[spot + 1] || ' (' || kind || ')']), b[spot + 2:]) ELSE list_append(b, 'Variation: ' || kind) END, chr(10))) AS rule_md5 FROM k""")
def q18_mutation_sim(spark, d):
    rows = _bulleted(spark, d).withColumn("mutated", u(7, "mutate", 1, F.col("doc_id")) < 0.15)
    rule = F.when(F.col("mutated"), evolve.mutated_bullets(F.col("b"), 7, 1, F.col("doc_id"))).otherwise(F.col("b"))
    return rows.select("doc_id", "mutated", F.md5(F.array_join(rule, "\n")).alias("rule_md5"))


@query("""WITH t AS (SELECT p_brand, p_type, row_number() OVER (ORDER BY min(p_partkey)) - 1 AS island_id FROM part WHERE p_size > 25 GROUP BY 1, 2)
SELECT coalesce(t.island_id, 0)::INT AS island_id, count(*) AS size, count(DISTINCT (p.p_brand, p.p_type)) AS pairs FROM part p LEFT JOIN t USING (p_brand, p_type) GROUP BY 1""")
def q19_route_stats(spark, d):
    part = table(spark, d, "part")
    tags = aggregate.islands(part.filter("p_size > 25"), "p_brand", "p_type", "p_partkey")
    rows = evolve.routed(part.select("p_partkey", "p_brand", "p_type", F.lit(0).alias("island_id")), tags, "p_brand", "p_type")
    return rows.groupBy("island_id").agg(F.count("*").alias("size"), F.count_distinct(F.struct("p_brand", "p_type")).alias("pairs"))


@query("""WITH r AS (SELECT o_orderkey, (o_orderstatus <> 'F')::INT AS src, (o_orderpriority <> '1-URGENT')::INT AS kind FROM orders),
n AS (SELECT *, row_number() OVER (ORDER BY src, kind, o_orderkey) - 1 AS id FROM r),
p AS (SELECT n.id, n.src, i, CASE i WHEN 0 THEN n.o_orderkey // 2 ELSE n.o_orderkey // 3 END AS old FROM n, range(2) t(i)),
m AS (SELECT p.id, p.i, coalesce(a.id, b.id) AS new FROM p LEFT JOIN n a ON a.o_orderkey = p.old AND a.src = p.src LEFT JOIN n b ON b.o_orderkey = p.old AND b.src <> p.src)
SELECT n.id, n.o_orderkey AS old_id, coalesce(string_agg(m.new::VARCHAR, ',' ORDER BY m.i) FILTER (m.new IS NOT NULL), '') AS parents FROM n LEFT JOIN m USING (id) GROUP BY 1, 2""")
def q20_merge_renumber(spark, d):
    key = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(key.alias("id"), key.alias("pos"), (F.col("o_orderpriority") != "1-URGENT").cast("int").alias("generation"), F.array(F.floor(key / 2), F.floor(key / 3)).alias("parents"), "o_orderstatus")
    out = merge.united_rules(rows.filter("o_orderstatus = 'F'").drop("o_orderstatus"), rows.filter("o_orderstatus != 'F'").drop("o_orderstatus"))
    return out.select("id", "old_id", F.array_join(F.transform("parents", lambda p: p.cast("string")), ",").alias("parents"))


_KNN = """WITH p AS (SELECT a.vec_id AS id, b.vec_id AS other, list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: pow(z[1]::DOUBLE - z[2]::DOUBLE, 2))) AS dist FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, other) AS rank FROM p),
k AS (SELECT id, min(dist) AS nearest, count(*) FILTER (dist < 1.2) AS repeat_count, min(other) FILTER (dist < 1.2) AS min_id FROM r WHERE rank < 500 GROUP BY 1),
knn AS (SELECT vec_id AS id, coalesce(nearest, -1) AS min_neighbor_distance, coalesce(repeat_count, 0) AS repeat_count, min_id AS min_similar_rule_id FROM embeddings LEFT JOIN k ON id = vec_id)"""


def _knn(spark, d):
    return neighbours.near_duplicates(table(spark, d, "embeddings").withColumn("pos", F.col("vec_id")), 500, 1.2, "pos", "vec_id")


@query(_KNN + " SELECT id, round(min_neighbor_distance, 6) AS min_neighbor_distance, repeat_count, min_similar_rule_id FROM knn")
def q21_knn(spark, d):
    return _knn(spark, d).select("id", _r("min_neighbor_distance").alias("min_neighbor_distance"), "repeat_count", "min_similar_rule_id")


@query(_KNN + " SELECT count(*) AS total, count(*) FILTER (min_similar_rule_id <> id) AS dup, count(*) - count(*) FILTER (min_similar_rule_id <> id) AS non_dup FROM knn")
def q22_dedup_counts(spark, d):
    return aggregate.dedup_counts(_knn(spark, d))


_TAGGED = "'<Format> ' || (quality + 4) || '</format>' || chr(10) || '<content_quality>' || (CASE WHEN doc_id % 11 = 0 THEN 'none' ELSE (3 + toxic)::VARCHAR END) || '</content_quality><feasibility>' || (doc_id % 6) || ' </feasibility>'"


def _score_texts(spark, d):
    doc = F.col("doc_id")
    made = F.concat(F.lit("<Format> "), F.col("quality") + 4, F.lit("</format>\n<content_quality>"), F.when(doc % 11 == 0, "none").otherwise((F.col("toxic") + 3).cast("string")), F.lit("</content_quality><feasibility>"), doc % 6, F.lit(" </feasibility>"))
    rows = table(spark, d, "labels").select("doc_id", text.int_tags(made, "format", "content_quality", "feasibility").alias("s"))
    return rows.select("doc_id", *(F.coalesce(F.col(f"s.{t}"), F.lit(-1)).alias(f"{t}_score") for t in ("format", "content_quality", "feasibility")))


_SCORES = f"""WITH t AS (SELECT doc_id, {_TAGGED} AS x FROM labels), e AS (SELECT doc_id, try_cast(regexp_extract(x, '(?is)<format>\\s*(\\d{{1,2}})\\s*</format>', 1) AS INT) AS a, try_cast(regexp_extract(x, '(?is)<content_quality>\\s*(\\d{{1,2}})\\s*</content_quality>', 1) AS INT) AS b, try_cast(regexp_extract(x, '(?is)<feasibility>\\s*(\\d{{1,2}})\\s*</feasibility>', 1) AS INT) AS c FROM t),
s AS (SELECT doc_id, CASE WHEN a + b + c IS NULL THEN -1 ELSE a END AS format_score, CASE WHEN a + b + c IS NULL THEN -1 ELSE b END AS content_quality_score, CASE WHEN a + b + c IS NULL THEN -1 ELSE c END AS feasibility_score FROM e)"""


@query(_SCORES + " SELECT * FROM s")
def q23_score_parse(spark, d):
    return _score_texts(spark, d)


@query(_SCORES + ", l AS (SELECT unnest(['format_score', 'content_quality_score', 'feasibility_score', 'total']) AS metric, unnest([format_score, content_quality_score, feasibility_score, format_score + content_quality_score + feasibility_score]) AS score FROM s) SELECT metric, score, count(*) AS n FROM l GROUP BY 1, 2")
def q24_score_hist(spark, d):
    return aggregate.score_histograms(_score_texts(spark, d), ["format_score", "content_quality_score", "feasibility_score"])


@query(_KNN + ", " + _SCORES.removeprefix("WITH ") + f", l AS {_again_sql('s', 'doc_id', format_score=('format_score', '1', '5'), content_quality_score=('content_quality_score', '1', '5'), feasibility_score=('feasibility_score', '1', '4'))} SELECT id, repeat_count, format_score, content_quality_score, feasibility_score FROM knn JOIN l ON doc_id = id WHERE repeat_count = 0 AND format_score + content_quality_score + feasibility_score >= 11 AND feasibility_score >= 3")
def q25_rule_filter(spark, d):
    every = lambda a, b: {"format_score": F.lit(a), "content_quality_score": F.lit(a), "feasibility_score": F.lit(b)}
    scores = _again(_score_texts(spark, d).withColumnRenamed("doc_id", "id"), "id", every(1, 1), every(5, 4))
    rows = merge.overlaid_scores(_knn(spark, d), scores)
    return select.good_rules(rows, 11, 3).select("id", "repeat_count", "format_score", "content_quality_score", "feasibility_score")


@query("SELECT conv_id, max(turn) AS turn, max_by(role, turn) AS role FROM conversations GROUP BY 1")
def q26_latest_attempt(spark, d):
    return aggregate.latest(table(spark, d, "conversations").select("conv_id", "turn", "role"), "conv_id", "turn").dropDuplicates(["conv_id"])


@query("""SELECT conv_id AS id, count(*) FILTER (role = 'user') AS n_correct, count(*) FILTER (role = 'assistant') AS n_incorrect, bool_or(contains(lower("text"), 'success')) AS succeeded FROM conversations GROUP BY 1 HAVING count(*) FILTER (role = 'user') = 2 AND count(*) FILTER (role = 'assistant') = 2""")
def q27_valid_counts(spark, d):
    kind = F.when(F.col("role") == "user", "output_correct").when(F.col("role") == "assistant", "output_incorrect")
    rows = table(spark, d, "conversations").select(F.col("conv_id").alias("id"), F.lit(1).alias("attempt"), kind.alias("kind"), F.lit("a.png").alias("path"), F.col("text").alias("test_result"))
    return select.complete_groups(aggregate.image_counts(rows, text.COUNT_EXTENSIONS), 2, 2)


_BITS = "SELECT vec_id // 8 AS id, (vec_id % 8)::INT AS idx, list_transform(embedding, lambda x: x > 0) AS b, label % 5 = 0 AS blank FROM embeddings"
_PAIRS = f"WITH h AS ({_BITS}), pairs AS (SELECT x.id, x.idx AS a, y.idx AS b, list_sum(list_transform(list_zip(x.b, y.b), lambda z: (z[1] <> z[2])::INT))::INT AS distance FROM h x JOIN h y ON x.id = y.id AND x.idx < y.idx), near AS (SELECT * FROM pairs WHERE distance <= 26)"


def _hashes(spark, d):
    vec = F.col("vec_id")
    return table(spark, d, "embeddings").select(F.floor(vec / 8).alias("id"), (vec % 8).cast("int").alias("idx"), F.array(scores.sign_bits(F.col("embedding"))).alias("phash"), (F.col("label") % 5 == 0).alias("blank"))


@query(_PAIRS + " SELECT id, a, b, distance FROM near")
def q28_hamming_pairs(spark, d):
    return neighbours.hash_pairs(_hashes(spark, d), 26)


@query(_PAIRS + ", n AS (SELECT id, count(*) AS n FROM near GROUP BY 1) SELECT h.id, coalesce(max(n.n), 0) >= 2 AS has_duplicate, bool_or(blank) AS has_blank FROM h LEFT JOIN n USING (id) GROUP BY 1")
def q28b_group_flags(spark, d):
    h = _hashes(spark, d)
    return neighbours.group_flags(h, neighbours.hash_pairs(h, 26))


@query(_PAIRS + ", x AS (SELECT id, a AS idx, b AS o FROM near UNION ALL SELECT id, b, a FROM near) SELECT id, idx, string_agg(o::VARCHAR, ',' ORDER BY o) AS dups FROM x GROUP BY 1, 2")
def q28c_duplicate_lists(spark, d):
    dups = neighbours.duplicates_of(neighbours.hash_pairs(_hashes(spark, d), 26))
    return dups.select("id", "idx", F.array_join(F.transform("dups", lambda x: x.cast("string")), ",").alias("dups"))


@query("""WITH f AS (SELECT n_chars > 2000 AS d, lang = 'fr' AS b FROM documents) SELECT count(*) FILTER (d AND NOT b) AS duplicate_only, count(*) FILTER (b AND NOT d) AS blank_only, count(*) FILTER (d AND b) AS "both", count(*) AS total FROM f""")
def q29_blank_categories(spark, d):
    return aggregate.category_counts(table(spark, d, "documents").select((F.col("n_chars") > 2000).alias("has_duplicate"), (F.col("lang") == "fr").alias("has_blank")))


def _groups(spark, d):
    """Parts as groups of five correct and three incorrect images. Their key alone is spread, before lists and hashes are made of it."""
    names = lambda kind, n: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.concat(F.col("p_partkey").cast("string"), F.lit(f"/{kind}"), i.cast("string"), F.lit(".png")))
    return spread(table(spark, d, "part").select("p_partkey")).select(F.col("p_partkey").alias("id"), names("c", 5).alias("correct"), names("w", 3).alias("incorrect"))


_FOUR = f"""WITH o AS (SELECT p_partkey AS id, i, CASE i WHEN 0 THEN p_partkey || '/c4.png' ELSE p_partkey || '/w' || (i - 1) || '.png' END AS image, {_u("'7'", "'options'", "p_partkey", "i")} AS k FROM part, range(4) t(i)),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k, i) - 1 AS slot FROM o)"""


@query(_FOUR + " SELECT id, string_agg(chr((65 + slot)::INT) || ': ' || image, chr(10) ORDER BY slot) AS options, max(chr((65 + slot)::INT)) FILTER (i = 0) AS correct_answer, 'A' AS compat_answer FROM r GROUP BY 1")
def q30_assemble4(spark, d):
    rows, old = assemble.four_options(_groups(spark, d), 7), assemble.four_options(_groups(spark, d), 7, compat=True)
    return rows.select("id", text.options_block(F.col("options")).alias("options"), "correct_answer").join(old.select("id", F.col("correct_answer").alias("compat_answer")), "id")


@query(f"""WITH w AS (SELECT p_partkey, s, i, p_partkey || '/w' || i || '.png' AS image, row_number() OVER (PARTITION BY p_partkey, s ORDER BY {_u("'7'", "'variant'", "p_partkey", "s", "i")}, i) - 1 AS nth FROM part, range(4) a(s), range(3) b(i)),
o AS (SELECT p_partkey, s, CASE WHEN nth < s THEN nth ELSE nth + 1 END AS slot, image FROM w UNION ALL SELECT p_partkey, s, s, p_partkey || '/c4.png' FROM part, range(4) a(s))
SELECT p_partkey || '_' || chr((65 + s)::INT) AS id, string_agg(chr((65 + slot)::INT) || ': ' || image, chr(10) ORDER BY slot) AS options, chr((65 + s)::INT) AS correct_answer FROM o GROUP BY p_partkey, s""")
def q31_variants(spark, d):
    return assemble.four_variants(_groups(spark, d), 7).select("id", text.options_block(F.col("options")).alias("options"), "correct_answer")


def _lineage(spark, d):
    """Chains of 16 parts with a short cut at every fifth; one part in ten is valid, so relatives lie deep, or are missing."""
    key = F.col("p_partkey")
    parents = F.array(F.when(key % 16 > 0, key - 1), F.when((key % 5 == 0) & (key % 16 > 1), key - 2))
    return table(spark, d, "part").select(key.alias("id"), F.filter(parents, lambda p: p > 0).alias("parents"), (F.col("p_size") % 10 == 0).alias("valid"))


def _relatives(spark, d):
    rules = _lineage(spark, d)
    return lineage.relatives(rules, rules.filter("valid").select("id"))


_RELATIVES = """WITH RECURSIVE up AS (SELECT p_partkey AS src, p_partkey - 1 AS dst FROM part WHERE p_partkey % 16 > 0 UNION ALL SELECT p_partkey, p_partkey - 2 FROM part WHERE p_partkey % 5 = 0 AND p_partkey % 16 > 1),
e AS (SELECT src, dst FROM up WHERE dst > 0 UNION SELECT dst, src FROM up WHERE dst > 0), v AS (SELECT p_partkey AS id FROM part WHERE p_size % 10 = 0),
reach(root, node, depth) USING KEY (root, node) AS (SELECT p_partkey AS root, p_partkey AS node, 0 AS depth FROM part UNION SELECT r.root, e.dst, r.depth + 1 FROM reach r JOIN e ON e.src = r.node WHERE NOT EXISTS (FROM recurring.reach x WHERE x.root = r.root AND x.node = e.dst)),
n AS (SELECT root, node, depth, row_number() OVER (PARTITION BY root ORDER BY depth, node) AS nth FROM reach JOIN v ON id = node WHERE node <> root),
rel AS (SELECT p_partkey AS id, list(node ORDER BY nth) FILTER (nth <= 2) AS r FROM part LEFT JOIN n ON root = p_partkey GROUP BY 1)"""


@query(_RELATIVES + " SELECT id, coalesce(array_to_string(r, ','), '') AS relatives FROM rel")
def q32_relatives(spark, d):
    return _relatives(spark, d).select("id", F.array_join(F.transform("relatives", lambda x: x.cast("string")), ",").alias("relatives"))


@query(_RELATIVES + f""", o AS (SELECT id, r, i, CASE WHEN i = 0 THEN id || '/c4.png' WHEN i < 4 THEN id || '/w' || (i - 1) || '.png' WHEN i < 7 THEN r[1] || '/w' || (i - 4) || '.png' ELSE r[2] || '/w' || (i - 7) || '.png' END AS image, {_u("'7'", "'ten'", "id", "i")} AS k FROM rel, range(10) t(i) WHERE len(r) = 2),
s AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k, i) - 1 AS slot FROM o)
SELECT id, string_agg(chr((65 + slot)::INT) || ': ' || image, chr(10) ORDER BY slot) AS options, max(chr((65 + slot)::INT)) FILTER (i = 0) AS correct_answer, array_to_string(any_value(r), ',') AS relatives_used FROM s GROUP BY id""")
def q33_assemble10(spark, d):
    rows = assemble.ten_options(_groups(spark, d), _relatives(spark, d), 7)
    return rows.select("id", text.options_block(F.col("options")).alias("options"), "correct_answer", F.array_join(F.transform("relatives_used", lambda x: x.cast("string")), ",").alias("relatives_used"))


@query(f"""SELECT d.doc_id AS id, d.source, md5(b.rule) AS rule_md5, b.kind AS question_type, b.point AS knowledge_point FROM documents d LEFT JOIN {_again_sql("benchmark", "item_id", rule=('"text"', "'older'", "''"), kind=("'benchmark'", "'older'", "'newer'"), point=("(item_id % 7)::VARCHAR", "NULL", "'newer'"))} b ON b.item_id = d.doc_id""")
def q34_explanation_join(spark, d):
    rules = table(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.array("text").alias("rule_content"), F.lit("benchmark").alias("question_type"), (F.col("item_id") % 7).cast("string").alias("knowledge_point"))
    older = {"rule_content": F.array(F.lit("older")), "question_type": F.lit("older"), "knowledge_point": F.lit(None).cast("string")}
    newer = {"rule_content": F.lit(None).cast("array<string>"), "question_type": F.lit("newer"), "knowledge_point": F.lit("newer")}
    rows = merge.with_meta(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source"), _again(rules, "id", older, newer))
    return rows.select("id", "source", F.md5(F.array_join("rule_content", "\n")).alias("rule_md5"), "question_type", "knowledge_point")


@query(f"SELECT d.doc_id AS id, d.source, l.dup AS has_duplicate FROM documents d JOIN {_again_sql('labels', 'doc_id', dup=('quality = 1', 'quality = 0', 'quality = 0'), blank=('toxic = 1', 'true', 'toxic = 0'))} l USING (doc_id) WHERE NOT l.blank")
def q35_blank_filter_join(spark, d):
    other = F.col("quality") == 0
    summary = table(spark, d, "labels").select("quality", "toxic", F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("has_duplicate"), (F.col("toxic") == 1).alias("has_blank"))
    summary = _again(summary, "id", {"has_duplicate": other, "has_blank": F.lit(True)}, {"has_duplicate": other, "has_blank": F.col("toxic") == 0})
    summary = summary.select(F.col("id").cast("string").alias("id"), "has_duplicate", "has_blank", "pos")
    return merge.without_blank(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source"), summary)


@query("""SELECT d.doc_id AS id, d.source, CASE WHEN l.doc_id % 13 <> 0 THEN (1 + l.quality)::INT END AS reasonableness, (4 + l.toxic)::INT AS readability FROM documents d LEFT JOIN labels l USING (doc_id)""")
def q36_final_scores(spark, d):
    from .puzzles import judged_scores

    doc = F.col("doc_id")
    record = F.concat(F.lit("So:\n<final_score>\n"), F.when(doc % 13 != 0, F.concat(F.lit("Reasonableness: "), F.col("quality") + 1)).otherwise(F.lit("Unsure")), F.lit("\nReadability:  "), F.col("toxic") + 4, F.lit("\n</final_score>"))
    records = table(spark, d, "labels").select(doc.alias("id"), record.alias("score"), F.lit(0).alias("pos"))
    return merge.with_scores(table(spark, d, "documents").select(doc.alias("id"), "source", doc.alias("pos")), judged_scores(records)).drop("pos")


@query(r"""SELECT user_id AS id, count(*) AS n, count(*) FILTER (CASE WHEN event_id % 10 = 0 THEN lower(event_type) || 's' ELSE event_type END = 'click') AS n_correct, round(count(*) FILTER (CASE WHEN event_id % 10 = 0 THEN lower(event_type) || 's' ELSE event_type END = 'click') / count(*), 6) AS accuracy FROM events GROUP BY 1""")
def q37_pass_rate(spark, d):
    said = F.when(F.col("event_id") % 10 == 0, F.concat(F.lower("event_type"), F.lit("s"))).otherwise(F.col("event_type"))
    rows = table(spark, d, "events").select(F.col("user_id").alias("id"), text.boxed(F.concat(F.lit("The answer is \\boxed{ "), said, F.lit("}"))).alias("parsed"))
    return aggregate.pass_rates(rows, correct=F.col("parsed") == "click").withColumn("accuracy", _r("accuracy"))


@query("""WITH c AS (SELECT conv_id, count(*) AS n FROM conversations WHERE role = 'assistant' GROUP BY 1), i AS (SELECT DISTINCT conv_id FROM conversations) SELECT i.conv_id AS id, unnest(range(coalesce(n, 0) + 1, 9)) AS attempt FROM i LEFT JOIN c USING (conv_id)""")
def q38_remaining_requests(spark, d):
    turns = table(spark, d, "conversations").select(F.col("conv_id").alias("id"), "role")
    return merge.owed_requests(turns.select("id").distinct(), turns.filter("role = 'assistant'"))


@query(f"""WITH a AS (SELECT * FROM {_again_sql("labels", "doc_id", v=("(quality + toxic / 2.0)::DOUBLE", "9.0::DOUBLE", "0.0::DOUBLE"))} WHERE doc_id % 5 <> 0) SELECT d.doc_id AS id, d.source, a.v AS accuracy FROM documents d LEFT JOIN a USING (doc_id)""")
def q39_accuracy_merge(spark, d):
    doc = F.col("doc_id")
    acc = _again(table(spark, d, "labels").select("doc_id", (F.col("quality") + F.col("toxic") / 2).cast("double").alias("value")), "doc_id", {"value": F.lit(9.0)}, {"value": F.lit(0.0)})
    acc = acc.select(F.when(doc % 5 == 0, F.concat(F.lit("id "), doc)).otherwise(doc.cast("string")).alias("key"), "value", "pos")
    return merge.with_accuracy(table(spark, d, "documents").select(doc.alias("id"), "source"), acc)


def _variants(spark, d):
    key = F.col("p_partkey")
    variants = table(spark, d, "part").select(F.explode(F.array(*(F.concat(key.cast("string"), F.lit(f"_{c}")) for c in "ABCD"), F.concat(F.lit("x"), key))).alias("id"))
    details = table(spark, d, "part").filter("p_size > 10").select(key.alias("id"), F.array("p_name").alias("rule_content"), F.col("p_brand").alias("question_type"), F.col("p_type").alias("knowledge_point"), (F.col("p_size") % 2 == 0).alias("has_duplicate"), F.col("p_retailprice").alias("accuracy"))
    older = {"question_type": F.lit("older"), "accuracy": F.lit(-1.0), "has_duplicate": F.lit(None).cast("boolean")}
    return variants, _again(details, "id", older, older | {"question_type": F.lit("newer")})


_VARIANTS = "WITH v AS (SELECT p_partkey AS k, unnest([p_partkey || '_A', p_partkey || '_B', p_partkey || '_C', p_partkey || '_D', 'x' || p_partkey]) AS id FROM part), p AS " + _again_sql(
    "(SELECT * FROM part WHERE p_size > 10)", "p_partkey", rule=("p_name",) * 3, kind=("p_brand", "'older'", "'newer'"), point=("p_type",) * 3, dup=("p_size % 2 = 0", "NULL", "NULL"), acc=("p_retailprice", "-1.0", "-1.0")
)


@query(_VARIANTS + " SELECT v.id, p.rule, p.kind AS question_type, p.point AS knowledge_point, p.dup AS has_duplicate, p.acc::DOUBLE AS accuracy, p.p_partkey IS NOT NULL AS matched FROM v LEFT JOIN p ON p.p_partkey = v.k AND NOT starts_with(v.id, 'x')")
def q40_prefix_join(spark, d):
    rows = merge.with_details(*_variants(spark, d))
    return rows.select("id", F.array_join("rule_content", "\n").alias("rule"), "question_type", "knowledge_point", "has_duplicate", "accuracy", "matched")


@query(_VARIANTS + " SELECT part.p_partkey AS id, p.kind AS question_type, p.dup AS has_duplicate, NULL::DOUBLE AS accuracy, p.p_partkey IS NOT NULL AS matched FROM part LEFT JOIN p USING (p_partkey)")
def q41_null_accuracy(spark, d):
    rows = merge.with_details(table(spark, d, "part").select(F.col("p_partkey").alias("id")), _variants(spark, d)[1], on=F.col("id"), null_accuracy=True)
    return rows.select("id", "question_type", "has_duplicate", "accuracy", "matched")


@query("SELECT o_orderkey || '_1' AS id, o_orderstatus AS v FROM orders UNION ALL SELECT o_orderkey || '_2', o_orderpriority FROM orders UNION ALL SELECT o_orderkey || '_3', NULL FROM orders")
def q42_union_styles(spark, d):
    orders = table(spark, d, "orders")
    key = F.col("o_orderkey").alias("id")
    return merge.united_styles([orders.select(key, F.col("o_orderstatus").alias("v")), orders.select(key, F.col("o_orderpriority").alias("v")), orders.select(key)])


@query("SELECT doc_id AS id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q43_resume_anti(spark, d):
    return merge.owed(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source"), table(spark, d, "labels").select(F.col("doc_id").alias("id")))


@query(f"SELECT count(*) FILTER (replaced) AS replaced, count(*) FILTER (NOT matched) AS missing, count(*) FILTER (matched AND NOT replaced) AS no_field FROM ({_OVERLAID})")
def q44_join_counters(spark, d):
    """Counted while the merged rows are written, in one execution."""
    rows, seen = merge.with_counters(_overlaid(spark, d))
    materialize(rows)
    found = merge.counters(seen)
    return spark.createDataFrame([tuple(found[c] for c in ("replaced", "missing", "no_field"))], "replaced long, missing long, no_field long")


@query("""SELECT r_regionkey AS generation, count(*) AS rules, '/runs/' || r_name AS path FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1, 3""")
def q45_checkpoint_list(spark, d):
    rows = table(spark, d, "nation").groupBy(F.col("n_regionkey").alias("generation")).agg(F.count("*").alias("rules"))
    saved = rows.join(table(spark, d, "region").select(F.col("r_regionkey").alias("generation"), F.concat(F.lit("/runs/"), F.col("r_name")).alias("path")), "generation")
    again = saved.withColumn("rules", F.lit(0).cast("long")).withColumn("saved_at", F.timestamp_seconds(F.lit(1)))
    return checkpoints.listed(saved.withColumn("saved_at", F.timestamp_seconds(F.lit(2))).unionByName(again)).select("generation", "rules", "path")


@query("SELECT doc_id AS id, CASE WHEN doc_id % 4 = 0 THEN 'again' ELSE lang END AS lang, source, n_chars FROM documents")
def q46_json_lines(spark, d):
    """Appended in three runs and read back, the last record of each id; every fourth comes twice."""
    path = scratch(spark)
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang", "source", "n_chars")
    for part in (rows.filter("lang = 'en'"), rows.filter("lang != 'en' or lang is null"), rows.filter("id % 4 = 0").withColumn("lang", F.lit("again"))):
        json_io.append_lines(part, path, json_io.last_run(spark, path) + 1)
    return json_io.resumed(spark, path, "id long, lang string, source string, n_chars long")


@query("""SELECT doc_id AS pos, doc_id AS id, md5("text") AS text_md5, source FROM documents""")
def q47_json_array(spark, d):
    """All documents as one JSON array in parts, and back."""
    path = scratch(spark)
    json_io.write_array(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "source"), path, "id")
    return json_io.read_array(spark, path, "id long, text string, source string").select("pos", "id", F.md5("text").alias("text_md5"), "source")


@query("""WITH c AS (SELECT unnest([o_orderkey // 2, o_orderkey // 3]) AS p, o_orderkey FROM orders), n AS (SELECT p, count(DISTINCT o_orderkey) AS t FROM c GROUP BY 1) SELECT o_orderkey AS id, coalesce(t, 0) AS times_used FROM orders LEFT JOIN n ON p = o_orderkey""")
def q48_parent_usage(spark, d):
    key = F.col("o_orderkey")
    return aggregate.parent_usage(table(spark, d, "orders").select(key.alias("id"), F.array(F.floor(key / 2), F.floor(key / 3)).alias("parents")))


@query("""SELECT event_id AS id, event_id // 500 AS batch, event_id // 16000 AS wave, CASE WHEN event_id % 9 = 0 THEN 'status 500' WHEN event_id % 7 = 0 THEN 'empty content' ELSE 'ok' END AS outcome FROM events""")
def q49_batch_outcomes(spark, d):
    """Batch responses joined back to their requests by position; malformed ids go."""
    key = F.col("event_id")
    requests = providers.batches(table(spark, d, "events").select(key.alias("id"), key.alias("pos")))
    answers = requests.select("custom_id", F.when(F.col("id") % 9 == 0, 500).otherwise(200).alias("status_code"), F.lit(None).cast("string").alias("error"), F.when(F.col("id") % 7 == 0, "").otherwise("yes").alias("content"))
    stray = answers.withColumn("custom_id", F.concat(F.lit("bad-"), "custom_id"))
    return merge.by_position(providers.batch_outcome(answers.unionByName(stray)), requests.drop("custom_id")).select("id", "batch", "wave", "outcome")


@query("""SELECT doc_id AS id, md5('Rate {n}: ' || lang || chr(10) || source || ' in ' || lang) AS prompt_md5 FROM documents""")
def q50_templates(spark, d):
    made = text.rendered("Rate {n}: {{lang}}\n{source} in {lang}", lang=F.col("lang"), source=F.col("source"))
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.md5(made).alias("prompt_md5"))


@query()
def q51_evolution(spark, d):
    """Three generations of islands of parts: invariants of the evolution are tested, its draws have no short SQL."""
    rules = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.split("p_name", " ").alias("rule_content"), F.col("p_brand").alias("question_type"), F.col("p_type").alias("knowledge_point"))
    return evolve.evolve(rules, evolve.Settings(generations=3)).drop("rule_content", "parents")




from . import catalog_steps  # noqa: E402, F401  registers its queries here
