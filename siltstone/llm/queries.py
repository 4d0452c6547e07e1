"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import Query, table
from . import alignment, byte_bpe, chat, language, licenses, packing, quality, token_counts, toxicity
from .exact_dedup import exact_dedup
from .hash_tree import EIGHT, grown, shards
from .jaccard_join import jaccard_components
from .labelled import fold
from .vector_codes import compress

TOXIC_FROM = 0.3


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents"), keep="largest")


OP1_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"))


# Sets of n-grams, pairs by what they share, and the smallest identifier that links reach, one step further a round.
OP2_SQL = r"""
WITH RECURSIVE cut AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS words
    FROM documents
), grams AS MATERIALIZED (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(words) = 0 THEN []
        WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS gram
    FROM cut
), sizes AS MATERIALIZED (
    SELECT doc_id, count(gram) AS n FROM documents LEFT JOIN grams USING (doc_id) GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS MATERIALIZED (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)
), both_ways AS MATERIALIZED (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM sizes
    UNION
    SELECT r.doc_id, w.b FROM reached r JOIN both_ways w ON w.a = r.other
)
SELECT doc_id, n AS n_shingles, min(other) AS component_id FROM sizes JOIN reached USING (doc_id) GROUP BY doc_id, n
"""


def op3_hash_tree(spark: SparkSession, folder: str) -> DataFrame:
    return shards(table(spark, folder, "documents"), EIGHT, grown(EIGHT, 8))


def _draw_sql(path: str, weight: int) -> str:
    """The draw of a child: 52 bits of an MD5 as u, then -ln(u) / weight."""
    bits = f"('0x' || substr(md5('{path}/' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::BIGINT"
    return f"-ln(({bits} + 0.5) / 4503599627370496.0) / {weight}"


def _smallest_sql(draws: dict[str, str]) -> str:
    """The value whose draw is the smallest."""
    pairs = ", ".join(f"{{'draw': {draw}, 'child': {child}}}" for child, draw in draws.items())
    return f"list_min([{pairs}]).child"


def _shard_sql() -> str:
    """Two regions of two racks of two shards, all of weight 1."""

    def rack(r: int, k: int) -> str:
        path = f"region{r}/rack{k}"
        return _smallest_sql({str(s): _draw_sql(f"{path}/{s}", 1) for s in (2 * k, 2 * k + 1)})

    def region(r: int) -> str:
        first, second = 2 * r, 2 * r + 1
        chosen = _smallest_sql({"0": _draw_sql(f"region{r}/rack{first}", 2), "1": _draw_sql(f"region{r}/rack{second}", 2)})
        return f"CASE WHEN {chosen} = 0 THEN {rack(r, first)} ELSE {rack(r, second)} END"

    return f"CASE top WHEN 0 THEN {region(0)} WHEN 1 THEN {region(1)} ELSE 8 END"


_REGIONS = {"0": _draw_sql("region0", 4), "1": _draw_sql("region1", 4)}
OP3_SQL = f"""
WITH steps AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS step
), sized AS (
    SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
           list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS bytes
    FROM documents
), summed AS (
    SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295, bytes),
        lambda c, b: xor(c // 256, step[xor(c % 256, b) + 1])), 4294967295) AS text_crc32
    FROM sized, steps
), placed AS (
    SELECT *, {_smallest_sql(_REGIONS)} AS top,
           {_smallest_sql(_REGIONS | {"2": _draw_sql("region-of-8", 1)})} AS grown_top
    FROM summed
), sharded AS (
    SELECT *, CAST({_shard_sql()} AS INTEGER) AS shard, CAST({_shard_sql().replace("CASE top", "CASE grown_top")} AS INTEGER) AS grown_shard
    FROM placed
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM sharded
"""


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    weights = toxicity.fit(docs, labels.where(fold("doc_id", 4) != 2))
    scored = docs.select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        toxicity.score(spark, weights, F.col("text")).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    verdict = quality.judge(spark, quality.fit(docs, labels), F.col("text"))
    return docs.select("doc_id", verdict.alias("verdict")).select("doc_id", "verdict.*")


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.fit(docs.where(fold("doc_id", 3) != 1))
    found = language.identify(spark, model, F.col("text"))
    held_out = (fold("doc_id", 3) == 1).alias("held_out")
    return docs.select("doc_id", held_out, found.alias("found")).select("doc_id", "held_out", "found.*")


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.section_counts(table(spark, folder, "documents"), byte_bpe.load())


def op6_chat_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    return chat.perspectives(table(spark, folder, "conversations"))


OP6_SQL = r"""
WITH speakers AS (
    SELECT DISTINCT conv_id, role AS participant FROM conversations WHERE role <> 'system'
), seen AS (
    SELECT conv_id, participant, turn, c.role AS speaker, coalesce(text, '') AS text,
           CASE WHEN c.role = participant THEN 'assistant' WHEN c.role = 'system' THEN 'system' ELSE 'user' END AS role,
           '<|' || CASE WHEN c.role = participant THEN 'assistant' WHEN c.role = 'system' THEN 'system'
                        ELSE 'user' || coalesce(' name=' || c.role, '') END || '|>' || chr(10) AS header
    FROM conversations c JOIN speakers USING (conv_id)
), placed AS (
    SELECT *, header || text || '<|end|>' || chr(10) AS segment,
           row_number() OVER dialogue - 1 AS seq,
           CAST(sum(length(header || text) + 8) OVER dialogue AS BIGINT) AS char_end
    FROM seen
    WINDOW dialogue AS (PARTITION BY conv_id, participant ORDER BY turn NULLS FIRST, speaker NULLS FIRST, text
                        ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, participant, seq, turn, role, segment, char_end - length(segment) AS char_start, char_end,
       CASE WHEN role = 'assistant' THEN char_end - length(segment) + length(header) END AS learn_start,
       CASE WHEN role = 'assistant' THEN char_end END AS learn_end
FROM placed
"""


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    trip = byte_bpe.round_trip(spark, byte_bpe.load(), F.col("text"))
    return table(spark, folder, "documents").select("doc_id", trip.alias("trip")).select("doc_id", "trip.*")


def op10_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return packing.best_fit(table(spark, folder, "documents"), token_counts.tokens_and_end(spark, byte_bpe.load()))


def op11_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents"))
    return found.withColumn("n_spans", F.size("spans")).drop("spans")


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    found = compress(table(spark, folder, "embeddings"))
    return found.rows.drop("label").withColumn("codebooks_sha256", F.lit(found.digest))


def _vector_codes_sql() -> str:
    """Two rounds of assignment and means, then the last assignment; all in integers."""
    nearest = """
nearest{r} AS (
    SELECT r, p, min({{'d': list_sum(list_transform(list_zip(part, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': entry}}) AS best
    FROM parts JOIN book{r} USING (p) GROUP BY r, p
)"""
    book = """
sums{r} AS (
    SELECT p, best.e AS entry, k, sum(part[k]) AS s, count(*) AS n
    FROM nearest{b} JOIN parts USING (r, p), w, LATERAL (SELECT unnest(range(1, width + 1)) AS k) GROUP BY ALL
),
means{r} AS (
    SELECT p, entry, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY k) AS c FROM sums{r} GROUP BY p, entry
),
book{r} AS (
    SELECT p, entry, coalesce(m.c, b.c) AS c FROM book{b} b LEFT JOIN means{r} m USING (p, entry)
)"""
    steps = [nearest.format(r=0)]
    for r in (1, 2):
        steps += [book.format(r=r, b=r - 1), nearest.format(r=r)]
    return f"""
WITH vectors AS (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
w AS (SELECT max(len(v)) // 16 AS width FROM vectors),
parts AS (
    SELECT r, p, list_slice(v, p * width + 1, (p + 1) * width) AS part FROM vectors, w, LATERAL (SELECT unnest(range(16)) AS p)
),
book0 AS (SELECT p, r - 1 AS entry, part AS c FROM parts WHERE r <= 64),{",".join(steps)},
coded AS (
    SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM nearest2 GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, entry)) FROM book2) AS codebooks_sha256
FROM vectors JOIN coded USING (r)
"""


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.alignments(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": Query(op1_exact_dedup, OP1_SQL),
    "op2_jaccard_join": Query(op2_jaccard_join, OP2_SQL),
    "op3_hash_tree": Query(op3_hash_tree, OP3_SQL),
    "op4_token_counts": Query(op4_token_counts),
    "op5_toxicity": Query(op5_toxicity),
    "op6_chat_perspectives": Query(op6_chat_perspectives, OP6_SQL),
    "op7_byte_bpe": Query(op7_byte_bpe),
    "op8_quality_rules": Query(op8_quality_rules),
    "op9_language": Query(op9_language),
    "op10_best_fit": Query(op10_best_fit),
    "op11_license_scan": Query(op11_license_scan),
    "op12_vector_codes": Query(op12_vector_codes, _vector_codes_sql()),
    "op13_alignment": Query(op13_alignment),
}
