"""Registered queries of the text operators and their DuckDB statements.

Each query applies its operator with production parameters to the whole of its
table and brings the result into the agreed columns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, hamming, html, jaccard, lines, merkle, mixing, periodic, pii, quality, secrets, simhash, syncmers
from tidemark.llm.common import table
from tidemark.session import tune

#: The letters that ASCII lower case changes.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}
RANKS = "byte_bpe_multi_50k.tiktoken"


def query(make: Query) -> Query:
    QUERIES[make.__name__] = lambda spark, folder: make(tune(spark), folder)
    return make


def _spans_text(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` by start, then by kind as listed, comma-joined."""
    rank = F.array(*[F.lit(k) for k in kinds])
    placed = F.transform(spans, lambda s: F.struct(s["start"], F.array_position(rank, s["kind"]), s["end"], s["kind"]))
    return F.array_join(
        F.transform(F.sort_array(placed), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _span_digests(found: DataFrame, base: tuple[str, ...], kinds: tuple[str, ...]) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, base), F.sha2(_spans_text(F.col("base"), kinds), 256).alias("base_sha256"),
        _spans_text(F.concat("base", "added"), kinds).alias("spans"),
    )


@query
def op1_html_extract(spark, folder):
    pages = html.extract(table(spark, folder, "pages"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op2_line_dedup(spark, folder):
    cleaned = lines.dedupe_lines(table(spark, folder, "documents"))
    return cleaned.select("doc_id", "text", "n_lines", "n_removed")


CHECKS["op2_line_dedup"] = f"""
WITH rows AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
places AS (SELECT doc_id, source, lines, unnest(range(len(lines))) AS place FROM rows),
lined AS (SELECT doc_id, coalesce(source, chr(0)) AS site, place, lines[place + 1] AS line FROM places),
spread AS (
  SELECT trim(line) AS line, count(DISTINCT site) AS sites, min(struct_pack(d := doc_id, p := place)) AS first
  FROM lined WHERE length(trim(line)) >= {lines.MIN_CHARS} GROUP BY 1
  HAVING count(DISTINCT site) >= (SELECT least({lines.MIN_SITES}, greatest(2, (count(DISTINCT coalesce(source, chr(0))) + 1) // 2)) FROM documents)
),
marked AS (
  SELECT l.doc_id, l.place, l.line,
         s.line IS NOT NULL AND NOT (s.first.d = l.doc_id AND s.first.p = l.place) AS gone
  FROM lined l LEFT JOIN spread s ON trim(l.line) = s.line
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS text,
       count(*) AS n_lines, count(*) FILTER (gone) AS n_removed
FROM marked GROUP BY doc_id
"""


@query
def op3_jaccard_join(spark, folder):
    return jaccard.join(table(spark, folder, "documents"), width=3, num=90, den=100)


@query
def op4_personal_data(spark, folder):
    return _span_digests(pii.find(table(spark, folder, "documents"), ["doc_id"]), pii.KINDS, pii.KINDS)


@query
def op5_quality(spark, folder):
    scored = quality.score(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select(
        "doc_id", "source", "lang", "quality_evidence", "quality_host", "quality_path", "quality_score", F.col("quality_keep").cast("int").alias("keep")
    )


@query
def op6_source_mix(spark, folder):
    return mixing.mix(table(spark, folder, "documents"), ["doc_id"])


CHECKS["op6_source_mix"] = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce('a' || source, 'b') AS place,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS hash
  FROM documents
),
sizes AS (SELECT place, sum(size)::BIGINT AS words, count(*) AS docs FROM sized GROUP BY 1),
weighted AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY place) - 1) % 3)::BIGINT + 1] AS weight,
         (sum(words) OVER ())::DOUBLE AS everything, (3 * words)::DOUBLE AS most
  FROM sizes
),
leveled AS (
  SELECT *, (everything - coalesce(sum(most) OVER (turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER turn AS turn_no
  FROM weighted WINDOW turn AS (ORDER BY most / weight, place)
),
targets AS (
  SELECT *, coalesce(least(weight * (SELECT arg_min(level, turn_no) FROM leveled WHERE most / weight > level), most), 0.0) AS target
  FROM leveled
),
ask1 AS (
  SELECT place, target AS votes, round(sum(target) OVER () / {mixing.BLOCK})::BIGINT AS seats,
         sum(target) OVER () AS total, count(*) FILTER (target > 0) OVER () AS n
  FROM targets
),
low1 AS (
  SELECT *, CASE WHEN votes > 0 THEN greatest(0, ceil(votes / total * (seats - n / 2) - 0.5 - 1e-6)) ELSE 0 END::BIGINT AS low,
         CASE WHEN votes > 0 THEN greatest(0, floor(votes / total * (seats + n / 2) + 0.5 + 1e-6)) ELSE 0 END::BIGINT AS high
  FROM ask1
),
try1 AS (SELECT place, votes, seats - sum(low) OVER () AS extra, low, high FROM low1),
won1 AS (
  SELECT place FROM (
    SELECT place, extra, row_number() OVER (ORDER BY votes / (2 * k + 1) DESC, place, k) AS rank
    FROM (SELECT *, unnest(range(low, high)) AS k FROM try1)
  ) WHERE rank <= extra
),
sources AS (
  SELECT t.place, t.words, t.target, any_value(y.low) + count(w.place) AS blocks,
         ceil(sqrt(greatest(1, ceil(any_value(t.words) / {mixing.SHARD_WORDS}), ceil(any_value(t.docs) / {mixing.SHARD_DOCS}))))::BIGINT AS n_groups,
         greatest(1, ceil(any_value(t.words) / {mixing.SHARD_WORDS}), ceil(any_value(t.docs) / {mixing.SHARD_DOCS})) AS n_shards
  FROM targets t JOIN try1 y USING (place) LEFT JOIN won1 w ON w.place = t.place GROUP BY ALL
),
spread AS (
  SELECT s.*, words, target, blocks, ('0x' || substr(hash, 1, 8))::BIGINT % n_groups AS grp,
         ('0x' || substr(hash, 9, 8))::BIGINT % ceil(n_shards / n_groups)::BIGINT AS shard
  FROM sized s JOIN sources USING (place)
),
cells AS (SELECT place, grp, shard, sum(size)::DOUBLE AS held, any_value(blocks) AS blocks FROM spread GROUP BY ALL),
ask2 AS (
  SELECT place, grp, votes, seats, sum(votes) OVER p AS total, count(*) FILTER (votes > 0) OVER p AS n
  FROM (SELECT place, grp, sum(held) AS votes, any_value(blocks) AS seats FROM cells GROUP BY ALL) WINDOW p AS (PARTITION BY place)
),
low2 AS (
  SELECT *, CASE WHEN votes > 0 THEN greatest(0, ceil(votes / total * (seats - n / 2) - 0.5 - 1e-6)) ELSE 0 END::BIGINT AS low,
         CASE WHEN votes > 0 THEN greatest(0, floor(votes / total * (seats + n / 2) + 0.5 + 1e-6)) ELSE 0 END::BIGINT AS high
  FROM ask2
),
try2 AS (SELECT *, seats - sum(low) OVER (PARTITION BY place) AS extra FROM low2),
won2 AS (
  SELECT place, grp FROM (
    SELECT place, grp, extra, row_number() OVER (PARTITION BY place ORDER BY votes / (2 * k + 1) DESC, grp, k) AS rank
    FROM (SELECT *, unnest(range(low, high)) AS k FROM try2)
  ) WHERE rank <= extra
),
groups AS (SELECT y.place, y.grp, any_value(y.low) + count(w.grp) AS share FROM try2 y LEFT JOIN won2 w ON w.place = y.place AND w.grp = y.grp GROUP BY ALL),
ask3 AS (
  SELECT place, grp, shard, held AS votes, share AS seats, sum(held) OVER p AS total, count(*) FILTER (held > 0) OVER p AS n
  FROM cells JOIN groups USING (place, grp) WINDOW p AS (PARTITION BY place, grp)
),
low3 AS (
  SELECT *, CASE WHEN votes > 0 THEN greatest(0, ceil(votes / total * (seats - n / 2) - 0.5 - 1e-6)) ELSE 0 END::BIGINT AS low,
         CASE WHEN votes > 0 THEN greatest(0, floor(votes / total * (seats + n / 2) + 0.5 + 1e-6)) ELSE 0 END::BIGINT AS high
  FROM ask3
),
try3 AS (SELECT *, seats - sum(low) OVER (PARTITION BY place, grp) AS extra FROM low3),
won3 AS (
  SELECT place, grp, shard FROM (
    SELECT place, grp, shard, extra, row_number() OVER (PARTITION BY place, grp ORDER BY votes / (2 * k + 1) DESC, shard, k) AS rank
    FROM (SELECT *, unnest(range(low, high)) AS k FROM try3)
  ) WHERE rank <= extra
),
quotas AS (
  SELECT y.place, y.grp, y.shard, any_value(y.low) + count(w.shard) AS quota
  FROM try3 y LEFT JOIN won3 w ON w.place = y.place AND w.grp = y.grp AND w.shard = y.shard GROUP BY ALL
),
laid AS (
  SELECT *, (sum(size) OVER (PARTITION BY place, grp, shard ORDER BY hash, doc_id, size ROWS UNBOUNDED PRECEDING))::BIGINT AS stop,
         (sum(size) OVER (PARTITION BY place, grp, shard))::BIGINT AS cell
  FROM spread JOIN quotas USING (place, grp, shard)
),
takes AS (SELECT *, least(quota * {mixing.BLOCK}, cell * 3)::BIGINT AS take FROM laid)
SELECT doc_id, source, size, words AS source_size, target,
       CASE WHEN cell = 0 THEN 0
            ELSE (take // cell) * size + greatest(0, least(stop, take % cell) - least(stop - size, take % cell)) END::BIGINT AS taken
FROM takes
"""


@query
def op7_byte_bpe(spark, folder):
    entries = bpe.read_ranks(spark, public_tokenizers.path(RANKS))
    encoded = bpe.encode(table(spark, folder, "documents"), entries, public_tokenizers.PATTERN, ["doc_id"], at_spaces=True)
    return bpe.digests(encoded, ["doc_id"])


@query
def op8_closed_syncmers(spark, folder):
    found = syncmers.edited_fingerprints(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


@query
def op9_secret_scan(spark, folder):
    return _span_digests(secrets.find(table(spark, folder, "documents"), ["doc_id"]), secrets.KINDS[:3], secrets.KINDS)


@query
def op10_hamming_topk(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return hamming.search(vectors, vectors.where(F.col("vec_id") % 100 == 0))


CHECKS["op10_hamming_topk"] = f"""
WITH codes AS (
  SELECT DISTINCT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x >= 0 THEN '1' ELSE '0' END), '') AS code
  FROM embeddings WHERE embedding IS NOT NULL
)
SELECT query_id, rank, vec_id, distance FROM (
  SELECT q.vec_id AS query_id, n.vec_id, hamming(q.code, n.code)::INTEGER AS distance,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY hamming(q.code, n.code), n.vec_id)::INTEGER AS rank
  FROM codes q JOIN codes n ON q.vec_id % 100 = 0 AND n.vec_id <> q.vec_id
) WHERE rank <= {hamming.K}
"""


@query
def op11_simhash_trie(spark, folder):
    return simhash.near_groups(table(spark, folder, "documents"))


@query
def op12_merkle_midstates(spark, folder):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    leaves = merkle.document_leaves(table(spark, folder, "documents"), tampered, F.translate("text", UPPER, LOWER))
    return merkle.manifest(leaves)


@query
def op13_periodic_runs(spark, folder):
    docs = table(spark, folder, "documents")
    found = periodic.find(docs.select("doc_id", periodic.planted(F.col("text"), F.col("doc_id")).alias("text")), ["doc_id"])
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "strongest.*",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
