"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logflow.llm import collocations, licenses, mixing, neardup, packing, passages, perplexity, runs, sharding, topk, toxicity, vptree, warc
from logflow.llm.common import WORD, table
from logflow.scratch import fresh_dir

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query and, where SQL can say the same, its check."""

    def register(fn: Run) -> Run:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query(
    "op2_top_k",
    """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    scored AS (SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
      FROM v q, v d WHERE q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
)
def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest integer inner products for every fiftieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@query("op7_vantage_point_trees")
def op7_vantage_point_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest vectors found for every twentieth vector."""
    return vptree.nearest(table(spark, sf_dir, "embeddings"))


@query("op4_mix")
def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


@query("op6_pack")
def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 1024 ids."""
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return packed.drop("ids")


@query("op1_warc")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to archives and read back from them."""
    archives = warc.write_archives(table(spark, sf_dir, "pages"), fresh_dir(spark, "warc"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return warc.read_archives(archives).select(*columns)


@query(
    "op8_near_duplicates",
    r"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(ws) < 2 THEN ws
        ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS sh FROM w),
    hashed AS (SELECT doc_id, sh, len(sh) AS n, md5(array_to_string(list_sort(sh), chr(10))) AS c FROM s WHERE len(sh) > 0),
    sets AS (SELECT c, any_value(sh) AS sh, any_value(n) AS n, min(doc_id) AS least FROM hashed GROUP BY c),
    items AS (SELECT c, n, unnest(sh) AS x FROM sets),
    counted AS (SELECT *, count(*) OVER (PARTITION BY x) AS f FROM items),
    rare AS (SELECT c, n, x FROM counted
      QUALIFY row_number() OVER (PARTITION BY c ORDER BY f, x) <= n - (4 * n + 4) // 5 + 1),
    pairs AS (SELECT DISTINCT a.c AS a, b.c AS b FROM rare a JOIN rare b ON a.x = b.x AND a.c < b.c
      AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n),
    shared AS (SELECT p.a, p.b, len(list_intersect(l.sh, r.sh)) AS i, l.n + r.n AS n
      FROM pairs p JOIN sets l ON l.c = p.a JOIN sets r ON r.c = p.b),
    links AS (SELECT a, b FROM shared WHERE 100 * i >= 80 * (n - i) UNION ALL SELECT b, a FROM shared WHERE 100 * i >= 80 * (n - i)),
    reach(c, other) AS (SELECT c, c FROM sets UNION SELECT r.c, l.b FROM reach r JOIN links l ON l.a = r.other),
    found AS (SELECT r.c, min(s.least) AS component_id FROM reach r JOIN sets s ON s.c = r.other GROUP BY r.c)
    SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, coalesce(f.component_id, s.doc_id) AS component_id,
      coalesce(f.component_id, s.doc_id) = s.doc_id AS kept
    FROM s LEFT JOIN hashed h ON h.doc_id = s.doc_id LEFT JOIN found f ON f.c = h.c
    """,
)
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on two-word shingles."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=2)


@query(
    "op5_repeated_passages",
    r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w),
    windows AS (SELECT doc_id, i, md5(array_to_string(ws[i : i + 49], ' ')) AS h FROM starts),
    firsts AS (SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h),
    repeated AS (SELECT doc_id, i FROM windows JOIN firsts USING (h) WHERE first_id < doc_id),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM repeated),
    words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
    kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
      FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
      sha256(coalesce(text, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)
    """,
)
def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that every document loses to passages of earlier ones."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    return passages.remove_repeats(rows).drop("text")


@query("op9_perplexity")
def op9_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document, its language's threshold and whether it is kept."""
    scored = perplexity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))[1]
    return scored.drop("chunk", "rid")


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated chance of toxicity of every document."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_license_scan")
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses and notices found in every document, with coverage and place."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query("op11_histogram_sort")
def op11_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard among 40 of near-equal bytes, and its place there."""
    sharded = sharding.shard_documents(table(spark, sf_dir, "documents"), shards=40)
    crc = F.crc32(F.coalesce("text", F.lit("")))
    grown = F.lit(None).cast("int").alias("grown_shard")
    return sharded.select("doc_id", "size", crc.alias("text_crc32"), "law", "shard", "slot", grown)


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """``doc_id, text``: of every tenth text, by a hash of its doc_id, the words from one place on repeat the first few there."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))
    rows = documents.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words"))
    rows = rows.withColumn("n", F.size("words").cast("long")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))

    def word(w, i):
        return F.when(i < F.col("a"), w).otherwise(F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))

    planted = F.concat_ws(" ", F.transform("words", word))
    return rows.select("doc_id", F.when(F.col("p").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs after planting some, the strongest one, and a digest of the text without them."""
    found = runs.find_runs(with_planted_runs(table(spark, sf_dir, "documents")), keep_runs=False)
    return found.drop("text", "n_words")


@query(
    "op13_phrase_graph",
    """
    WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents WHERE text IS NOT NULL),
    words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE len(w) > 0),
    totals AS (SELECT lang, count(*) AS n FROM starts GROUP BY lang),
    grams AS (SELECT lang, k, w[i : i + k - 1] AS g, count(*) AS f
      FROM starts, (VALUES (1), (2), (3)) sizes(k) WHERE i + k - 1 <= len(w) GROUP BY lang, k, w[i : i + k - 1]),
    c AS (SELECT * FROM grams WHERE f >= 10),
    cuts AS (SELECT c.lang, c.k, c.g, c.f AS a, l.k AS cut, l.f AS l, r.f AS r,
        (1000000::HUGEINT * c.f * c.f) // (l.f::HUGEINT * r.f) AS score
      FROM c JOIN c l ON l.lang = c.lang AND l.k < c.k AND l.g = c.g[1 : l.k]
      JOIN c r ON r.lang = c.lang AND r.k = c.k - l.k AND r.g = c.g[l.k + 1 : c.k]),
    best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
    inner_ones AS (SELECT DISTINCT b.lang, b.g FROM best b JOIN c t ON t.lang = b.lang AND b.k = 2 AND t.k = 3
      AND (b.g = t.g[1 : 2] OR b.g = t.g[2 : 3]) AND 100 * t.f >= 50 * b.a),
    kept AS (SELECT b.*, array_to_string(b.g, ' ') AS phrase FROM best b ANTI JOIN inner_ones i ON i.lang = b.lang AND i.g = b.g),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
)
def op13_phrase_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's strongest collocations of two and three words."""
    return collocations.strongest_collocations(table(spark, sf_dir, "documents"))
