"""The queries of this package, each over its whole table, and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: five words, similarity of 0.8 or more."""
    from floodledger.llm.ngram_join import similar_documents

    return similar_documents(table(spark, sf_dir, "documents"), 80, 5)


WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

ORACLES["op1_ngram_jaccard_join"] = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS} AS w FROM documents WHERE doc_id IS NOT NULL),
s AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w
),
n AS (SELECT doc_id, coalesce(len(s), 0) AS n, s FROM s),
c AS (SELECT min(doc_id) AS rep, any_value(n) AS n, any_value(s) AS s FROM n WHERE n > 0 GROUP BY list_sort(s)),
e AS (SELECT rep, n, unnest(s) AS x FROM c),
common AS (
    SELECT a.rep AS a, b.rep AS b, a.n AS na, b.n AS nb, count(*) AS shared FROM e a JOIN e b
    ON a.x = b.x AND a.rep < b.rep AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n GROUP BY 1, 2, 3, 4
),
link AS (SELECT a, b FROM common WHERE 100 * shared >= 80 * (na + nb - shared)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT rep, rep FROM c UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b),
top AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY 1),
cls AS (SELECT list_sort(s) AS k, min(doc_id) AS rep FROM n WHERE n > 0 GROUP BY 1)
SELECT n.doc_id, n.n AS n_shingles, coalesce(top.component_id, n.doc_id) AS component_id, coalesce(cls.rep, n.doc_id) AS class_id
FROM n LEFT JOIN cls ON n.n > 0 AND list_sort(n.s) = cls.k LEFT JOIN top ON top.rep = cls.rep
"""


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents."""
    from floodledger.llm.quality import scored

    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents."""
    from floodledger.llm.language import identified

    return identified(table(spark, sf_dir, "documents"))


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a document and a benchmark item of whose shingles it holds 0.8 or more."""
    from floodledger.llm.decontaminate import contained_items

    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 0.8, 5)


ORACLES["op5_benchmark_decontamination"] = rf"""
WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents WHERE doc_id IS NOT NULL),
i AS (SELECT item_id, {WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
g AS (
    SELECT item_id, least(len(w), 5) AS k, list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM i WHERE len(w) > 0
),
wanted AS (SELECT item_id, k, len(s) AS n, unnest(s) AS x FROM g),
widths AS (SELECT DISTINCT k FROM wanted),
held AS (
    SELECT DISTINCT doc_id, k, x FROM (
        SELECT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS x FROM w, widths
    )
)
SELECT doc_id, item_id, n AS n_shingles, count(*) AS n_shared, count(*) / n::DOUBLE AS containment
FROM held JOIN wanted USING (k, x) GROUP BY doc_id, item_id, n HAVING count(*) >= 0.8 * n
"""


@query
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in a mixture that weighs sources by the roots of their sizes."""
    from floodledger.llm.mixing import mix_sources

    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "position", "slot", "release", "deadline")


@query
def op10_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in rows of 2048."""
    from floodledger.llm.packing import packed

    return packed(table(spark, sf_dir, "documents"), 2048)


@query
def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 50-byte strings of earlier ones."""
    from floodledger.llm.suffix_dedup import without_repeats

    return without_repeats(table(spark, sf_dir, "documents"), keep_bytes=False)


ORACLES["op7_suffix_array_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents WHERE doc_id IS NOT NULL),
n AS (SELECT doc_id, h, len(h) // 2 AS n FROM d),
s AS (SELECT doc_id, unnest(range(n - 49)) AS i, h FROM n WHERE n >= 50),
w AS (SELECT doc_id, i, hash(substr(h, 2 * i + 1, 100)) AS a, md5_number_lower(substr(h, 2 * i + 1, 100)) AS b FROM s),
m AS (SELECT a, b, min(doc_id) AS least FROM w GROUP BY a, b),
hit AS (SELECT w.doc_id, w.i FROM w JOIN m USING (a, b) WHERE m.least < w.doc_id),
gap AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 50, true) AS fresh FROM hit),
run AS (SELECT doc_id, i, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM gap),
span AS (SELECT doc_id, r, min(i) AS a, max(i) + 50 AS b FROM run GROUP BY doc_id, r),
part AS (
    SELECT n.doc_id, span.r, substr(n.h, 2 * coalesce(lag(span.b) OVER (PARTITION BY n.doc_id ORDER BY span.a), 0) + 1,
        2 * (span.a - coalesce(lag(span.b) OVER (PARTITION BY n.doc_id ORDER BY span.a), 0))) AS piece, span.a, span.b, n.h, n.n
    FROM n JOIN span USING (doc_id)
),
cut AS (
    SELECT doc_id, any_value(n) AS n, sum(b - a)::BIGINT AS gone, count(*) AS spans,
        string_agg(piece, '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS rest
    FROM part GROUP BY doc_id
)
SELECT n.doc_id, n.n AS n_bytes, coalesce(cut.gone, 0) AS n_removed, coalesce(cut.spans, 0) AS n_spans,
    sha256(unhex(coalesce(cut.rest, n.h))) AS kept_sha256
FROM n LEFT JOIN cut USING (doc_id)
"""


@query
def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every vector whose number is divisible by 50."""
    from floodledger.llm.vectors import neighbours

    return neighbours(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", 5)


@query
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    from floodledger.llm.main_text import extracted

    return extracted(table(spark, sf_dir, "pages"))


@query
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    from floodledger.llm.personal import personal_data

    return personal_data(table(spark, sf_dir, "documents"))


@query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of all documents."""
    from floodledger.llm.toxicity import scored

    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of five filters in all 120 orders, by source."""
    from floodledger.llm.filter_audit import audit

    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op12_filter_audit"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
        + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT
        + 8 * regexp_matches(t, '[#$%&*|]')::INT
        + 16 * coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)::INT AS mask
    FROM d LEFT JOIN l USING (doc_id)
),
n AS (SELECT part, mask, good, toxic, count(*) AS n FROM f GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS b),
perm AS (
    SELECT p.x || q.x || r.x || s.x || t.x AS filter_order, [p.b, q.b, r.b, s.b, t.b] AS bits
    FROM letter p, letter q, letter r, letter s, letter t WHERE p.b + q.b + r.b + s.b + t.b = 31 AND p.b | q.b | r.b | s.b | t.b = 31
),
step AS (
    SELECT filter_order, bits[k] AS bit, coalesce(list_sum(bits[1:k - 1]), 0)::INT AS before, k::INT AS step
    FROM (SELECT *, unnest(range(1, 6)) AS k FROM perm)
),
counts AS (
    SELECT part, filter_order, step, bit, sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n * good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n * toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM n, step GROUP BY part, filter_order, step, bit
)
SELECT * EXCLUDE (bit), sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM counts
"""


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents rearranged for fill-in-the-middle training and put back, as digests."""
    from pyspark.sql import functions as F

    from floodledger.llm.fill_middle import fill_in_middle, restored

    back = restored(fill_in_middle(table(spark, sf_dir, "documents")))
    return back.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


ORACLES["op13_fill_in_middle"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || doc_id) AS h
    FROM documents WHERE doc_id IS NOT NULL
),
g AS (
    SELECT doc_id, t, u, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS x, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS y,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 100 THEN 'plain'
            WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d
),
p AS (
    SELECT doc_id, t, n::BIGINT AS n, form, array_to_string(u[1:least(x, y)], '') AS pre,
        array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS mid, array_to_string(u[greatest(x, y) + 1:n], '') AS suf FROM g
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM p
"""
