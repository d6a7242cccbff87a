"""The operators' queries over whole tables, and SQL for those it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselog.llm import (
    chat,
    decontam,
    hard_negatives,
    langid,
    line_dedup,
    merkle,
    mixing,
    ngram_join,
    packing,
    quality_net,
    quality_rules,
    suffix_dedup,
    warc,
)
from pulselog.llm.common import remainder
from pulselog.session import scratch_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    model = langid.fit(docs.where(~held_out).select("doc_id", "text", "lang"))
    return langid.identify(docs, model, ("doc_id", held_out.alias("held_out")))


CONTROL = "</s>[INST] ok [/INST]"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL).alias("text"),
    )
    return chat.digests(chat.expand(turns.unionByName(extra)))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    index = warc.write_archives(_table(spark, sf_dir, "pages"), folder)
    return warc.read_records(index, folder).drop("url", "payload")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffix_dedup.deduplicate(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.groups(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_quality_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    model = quality_net.fit(docs, labels.where(~held_out))
    scored = quality_net.score(docs, model, ("doc_id", held_out.alias("held_out")))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.clean(docs).drop("clean_text")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.deduplicate(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(
        _table(spark, sf_dir, "documents").select("doc_id", "text"),
        _table(spark, sf_dir, "benchmark").select("item_id", "text"),
    )


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    hit = F.coalesce(remainder("doc_id", 2) == 0, F.lit(False))
    found = F.when(hit, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return merkle.manifest(docs, found)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op13_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_chat_format,
        op3_warc,
        op4_suffix_dedup,
        op5_ngram_join,
        op6_quality_net,
        op7_line_rules,
        op8_line_dedup,
        op9_decontaminate,
        op10_pack,
        op11_merkle_manifest,
        op12_hard_negatives,
        op13_mix_sources,
    )
}

# What the template adds to a turn's role and text: two marks and two line feeds.
_MARKS = len(chat.OPEN) + len(chat.CLOSE) + 1
_ESCAPED = "replace(coalesce(text, ''), '%', '%25')"
for _control in chat.CONTROLS:
    _ESCAPED = f"replace({_ESCAPED}, '{_control}', '%{ord(_control[0]):02X}{_control[1:]}')"

ORACLES: dict[str, str] = {
    "op2_chat_format": f"""
        WITH turns AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            SELECT -7, n, r, '{CONTROL}' FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(n, r)
        ), measured AS (
            SELECT *, sum(length(role) + length({_ESCAPED}) + {_MARKS})
                OVER (PARTITION BY conv_id ORDER BY turn, role, text
                      ROWS UNBOUNDED PRECEDING) AS size,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC)
                AS behind
            FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
                AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT)
                AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(size) FILTER (role = 'assistant' OR behind = 1) AS BIGINT) AS formatted_chars
        FROM measured GROUP BY conv_id""",
    "op3_warc": f"""
        WITH payloads AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), kept AS (
            SELECT payload, max(page_id) AS page_id FROM payloads
            WHERE octet_length(payload) >= {warc.REVISIT_BYTES} GROUP BY payload
        )
        SELECT p.page_id, CAST(octet_length(p.payload) AS BIGINT) AS payload_bytes,
            sha1(p.payload) AS payload_digest,
            CASE WHEN k.page_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN k.page_id <> p.page_id THEN k.page_id END AS refers_to
        FROM payloads p LEFT JOIN kept k ON p.payload = k.payload""",
}

# CRC-32 of a text of digits, bit by bit: eight steps a byte, folded over the bytes.
_POLYNOMIAL = 0xEDB88320
_CRC32 = f"""xor(list_reduce(
            list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
            lambda crc, byte: list_reduce(range(8),
                lambda bits, step: xor(bits >> 1, (bits & 1) * {_POLYNOMIAL}), xor(crc, byte)),
            CAST(4294967295 AS BIGINT)), 4294967295)"""


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


_FIXED = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))

ORACLES |= {
    "op11_merkle_manifest": f"""
        WITH RECURSIVE named AS (
            SELECT doc_id, coalesce('=' || source, '-') AS tree,
                sha256({_FIXED} || {_field("text")}) AS leaf,
                sha256({_FIXED} || {_field(
                    f"CASE WHEN {_CRC32} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"
                )}) AS claim
            FROM documents
        ), leaves AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1
                AS place, count(*) OVER (PARTITION BY tree) AS n FROM named
        ), nodes(level, tree, place, digest, n) AS (
            SELECT 0, tree, place, leaf, n FROM leaves
            UNION ALL
            SELECT level + 1, tree, place // 3, sha256(string_agg(digest, '' ORDER BY place)),
                (n + 2) // 3
            FROM nodes WHERE n > 1 GROUP BY level, tree, place // 3, n
        ), subroots AS (
            SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS place,
                count(*) OVER () AS n
            FROM nodes WHERE n = 1
        ), tops(level, place, digest, n) AS (
            SELECT 0, place, digest, n FROM subroots
            UNION ALL
            SELECT level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)),
                (n + 2) // 3
            FROM tops WHERE n > 1 GROUP BY level, place // 3, n
        ), heights AS (
            SELECT tree, max(level) AS height FROM nodes GROUP BY tree
        ), ways AS (
            -- Every leaf's places, level by level, up its source's tree and on in the top tree.
            SELECT l.doc_id, l.tree, l.place AS leaf_place, s.level, s.place, s.digest, s.n
            FROM leaves l JOIN nodes s ON s.tree = l.tree
                AND s.place // 3 = l.place // CAST(pow(3, s.level + 1) AS BIGINT) AND s.n > 1
            UNION ALL
            SELECT l.doc_id, l.tree, l.place, h.height + t.level, t.place, t.digest, t.n
            FROM leaves l JOIN heights h USING (tree) JOIN subroots r ON r.tree = l.tree
            JOIN tops t ON t.place // 3 = r.place // CAST(pow(3, t.level + 1) AS BIGINT) AND t.n > 1
        ), owned AS (
            SELECT w.*, w.place = CASE WHEN w.level < h.height
                    THEN w.leaf_place // CAST(pow(3, w.level) AS BIGINT)
                    ELSE r.place // CAST(pow(3, w.level - h.height) AS BIGINT) END AS own
            FROM ways w JOIN heights h USING (tree) JOIN subroots r USING (tree)
        ), steps AS (
            SELECT tree, leaf_place, level,
                coalesce(string_agg(digest, '' ORDER BY place) FILTER (NOT own AND place < mine), '')
                    AS head,
                coalesce(string_agg(digest, '' ORDER BY place) FILTER (NOT own AND place > mine), '')
                    AS tail
            FROM (SELECT *, max(CASE WHEN own THEN place END)
                OVER (PARTITION BY tree, leaf_place, level) AS mine FROM owned)
            GROUP BY tree, leaf_place, level
        ), folds(tree, place, level, digest) AS (
            SELECT tree, place, 0, claim FROM leaves
            UNION ALL
            SELECT f.tree, f.place, f.level + 1, sha256(s.head || f.digest || s.tail)
            FROM folds f JOIN steps s
                ON s.tree = f.tree AND s.leaf_place = f.place AND s.level = f.level
        ), folded AS (
            SELECT tree, place, arg_max(digest, level) AS folded_root FROM folds GROUP BY tree, place
        ), proofs AS (
            SELECT tree, leaf_place AS place, string_agg(head || tail, '' ORDER BY level) AS proof
            FROM steps GROUP BY tree, leaf_place
        ), top AS (
            SELECT digest AS root FROM tops WHERE n = 1
        )
        SELECT l.doc_id, l.leaf, r.digest AS subroot, top.root,
            sha256(coalesce(p.proof, '')) AS proof_sha256, f.folded_root,
            f.folded_root = top.root AS verified
        FROM leaves l JOIN subroots r ON r.tree = l.tree
        JOIN folded f ON f.tree = l.tree AND f.place = l.place
        LEFT JOIN proofs p ON p.tree = l.tree AND p.place = l.place CROSS JOIN top""",
    "op12_hard_negatives": f"""
        WITH vectors AS (
            SELECT vec_id,
                CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10
                    ELSE CAST(label AS BIGINT) END AS label,
                list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS codes
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scores AS (
            SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same,
                CAST(list_inner_product(a.codes, r.codes) AS BIGINT) AS score
            FROM vectors a JOIN vectors r ON r.vec_id <> a.vec_id
            WHERE a.vec_id % 100 = 0
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {hard_negatives.POSITIVES}
        )
        SELECT p.anchor_id, p.positive_id,
            CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
            s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
        FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
            AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
        QUALIFY rank <= {hard_negatives.NEGATIVES}""",
    "op13_mix_sources": f"""
        WITH sized AS (
            SELECT doc_id, coalesce('=' || source, '~') AS name,
                coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size
            FROM documents
        ), sources AS (
            SELECT name, CAST(sum(size) AS BIGINT) AS source_size,
                [5, 2, 1][(row_number() OVER (ORDER BY name) - 1) % 3 + 1] AS weight
            FROM sized GROUP BY name
        ), ordered AS (
            -- Sources stop at twice their size in the order of that bound over their weight.
            SELECT *, 2.0 * source_size AS most,
                row_number() OVER (ORDER BY 2.0 * source_size / weight, name) AS turn
            FROM sources
        ), levels AS (
            SELECT *,
                (1.5 * sum(source_size) OVER () - (sum(most) OVER (ORDER BY turn) - most)) /
                    (sum(weight) OVER () - (sum(weight) OVER (ORDER BY turn) - weight)) AS part
            FROM ordered
        ), level AS (
            SELECT CAST(arg_min(part, turn) AS DOUBLE) AS part FROM levels WHERE weight * part <= most
        ), targets AS (
            SELECT name, source_size, least(weight * level.part, CAST(most AS DOUBLE)) AS target
            FROM ordered, level
        ), rates AS (
            SELECT *, CAST(floor(target / greatest(source_size, 1) * {mixing.UNIT}) AS BIGINT) AS rate,
                CAST('0x' || substr(md5('{mixing.SEED}' || name), 1, 6) AS BIGINT) AS start
            FROM targets
        ), sums AS (
            SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN rate ELSE 0 END AS own,
                start + sum(CASE WHEN size > 0 THEN rate ELSE 0 END) OVER (
                    PARTITION BY name ORDER BY size, doc_id NULLS FIRST
                    ROWS UNBOUNDED PRECEDING) AS after
            FROM sized JOIN rates USING (name)
        )
        SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
            CAST(size * (after // {mixing.UNIT} - (after - own) // {mixing.UNIT}) AS BIGINT) AS taken
        FROM sums""",
}
