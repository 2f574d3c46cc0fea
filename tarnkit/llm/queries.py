"""Registered queries of the subpackage: each dealt operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnkit.llm.collocations import collocations
from tarnkit.llm.decontamination import LEAST_WORDS, MASKS, SHIFT, SIMILARITY, contamination
from tarnkit.llm.exact_dedup import exact_dedup
from tarnkit.llm.html_extract import extract_pages
from tarnkit.llm.language_id import held_out, identify_languages, train
from tarnkit.llm.language_model import score_texts
from tarnkit.llm.line_dedup import dedup_lines
from tarnkit.llm.merkle import fold, leaf_hash, merkle_manifest
from tarnkit.llm.near_dedup import near_duplicates
from tarnkit.llm.packing import pack_documents
from tarnkit.llm.sharding import shard_rows
from tarnkit.llm.token_counts import count_tokens
from tarnkit.llm.url_filter import filter_urls
from tarnkit.llm.workers import importable

SHARDS = 40
MAX_TOKENS = 2048
URL_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


def _path(sf_dir: str, table: str) -> str:
    return f"{sf_dir.rstrip('/')}/{table}.parquet"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(_path(sf_dir, table))


def word_bpe() -> str:
    """The word BPE's file, where the tokenizers are installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract_pages(_read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, _path(sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, with the item and where it stands."""
    found = contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", "n_matched", "n_words")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = _read(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
    )
    return shard_rows(rows, SHARDS, "doc_id").withColumn("grown_shard", F.lit(None).cast("int"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = dedup_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    found = identify_languages(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_read(spark, sf_dir, "documents"), word_bpe())


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    judged = filter_urls(pages, _read(spark, sf_dir, "documents").select("text"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(_read(spark, sf_dir, "documents"), word_bpe(), MAX_TOKENS)
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > MAX_TOKENS).alias("over_limit"), "fit_chars"
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's leaf, roots and proof, and whether a leaf that was tampered with still gives the root."""
    docs = _read(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    tampered = F.when(
        F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.unhex(leaf_hash([changed if c == "n_chars" else c for c in columns]))
    )
    manifest = merkle_manifest(docs, leaf_hash(columns), "lang", "doc_id", [tampered.alias("tampered")])
    claimed = F.coalesce(F.lower(F.hex("tampered")), F.col("leaf"))
    folded = manifest.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"), fold(claimed).alias("folded_root")
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_read(spark, sf_dir, "documents")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string")) % 7
    scored = score_texts(_read(spark, sf_dir, "documents"), remainder != 2)
    columns = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return scored.select("doc_id", (remainder == 2).alias("held_out"), *columns)


QUERIES = {f.__name__: f for f in (
        op1_html_extraction,
        op2_exact_dedup,
        op3_decontamination,
        op4_sharding,
        op5_line_dedup,
        op6_near_dedup,
        op7_language_id,
        op8_packing,
        op9_url_filters,
        op10_token_counts,
        op11_merkle_manifest,
        op12_collocations,
        op13_lm_scoring,
    )}

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _decontamination_sql() -> str:
    """Every seed of every document against every seed of every item, and the layers that follow."""
    span = len(MASKS[0])

    def seeds(table: str, id_: str, whole: bool) -> str:
        parts = [
            f"SELECT {id_}, i, {m} AS kind, [{', '.join(f'w[i + {k}]' for k in range(span) if mask[k] == '1')}] AS seed "
            f"FROM (SELECT {id_}, w, unnest(range(1, len(w) - {span - 2})) AS i FROM {table} WHERE len(w) >= {span})"
            for m, mask in enumerate(MASKS)
        ]
        for n in range(LEAST_WORDS, span):
            where = f"len(w) = {n}" if whole else f"len(w) >= {n}"
            parts.append(
                f"SELECT {id_}, i, -{n} AS kind, w[i : i + {n - 1}] AS seed "
                f"FROM (SELECT {id_}, w, unnest(range(1, len(w) - {n - 2})) AS i FROM {table} WHERE {where})"
            )
        return " UNION ALL ".join(parts)

    words = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w"
    return f"""
        WITH d AS (SELECT doc_id, {words} FROM documents), b AS (SELECT item_id, {words} FROM benchmark),
        ds AS ({seeds("d", "doc_id", False)}),
        bs AS ({seeds("b", "item_id", True)}),
        layers AS (SELECT DISTINCT doc_id, item_id, (ds.i - bs.i)::INT AS layer FROM ds JOIN bs USING (kind, seed)),
        places AS (SELECT item_id, len(w) AS n_words, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM b),
        judged AS (
            SELECT l.doc_id, l.item_id, l.layer, n_words::INT AS n_words, count(DISTINCT p)::INT AS n_matched
            FROM layers l JOIN layers m ON m.doc_id = l.doc_id AND m.item_id = l.item_id AND abs(m.layer - l.layer) <= {SHIFT}
            JOIN places ON places.item_id = l.item_id JOIN d ON d.doc_id = l.doc_id
            WHERE m.layer + p >= 1 AND d.w[m.layer + p] = word
            GROUP BY ALL)
        SELECT doc_id, item_id, layer AS start, n_matched, n_words FROM judged WHERE 100 * n_matched >= {SIMILARITY} * n_words
        QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_matched DESC, layer) = 1"""


def _merkle_sql() -> str:
    """Both trees level by level, and the tampered leaves folded along their siblings."""

    def levels(name: str, of: str) -> str:
        return f"""{name} AS (
            SELECT g, 0 AS level, pos, n, h FROM {of}
            UNION ALL
            SELECT g, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY g, level, pos // 2, n)"""

    def proof(of: str, tree: str, key: str) -> str:
        return f"""SELECT o.{key}, string_agg(t.h, '' ORDER BY t.level) AS proof FROM {of} o JOIN {tree} t
                   ON t.g = o.g AND t.pos = xor(o.pos >> t.level, 1) GROUP BY o.{key}"""

    def folded(name: str, of: str, tree: str) -> str:
        return f"""{name} AS (
            SELECT doc_id, g, 0 AS level, pos, n, h FROM {of}
            UNION ALL
            SELECT f.doc_id, f.g, f.level + 1, f.pos // 2, (f.n + 1) // 2,
                   sha256(CASE WHEN f.pos % 2 = 1 THEN t.h || f.h ELSE f.h || coalesce(t.h, '') END)
            FROM {name} f LEFT JOIN {tree} t ON t.g = f.g AND t.level = f.level AND t.pos = xor(f.pos, 1) WHERE f.n > 1)"""

    def leaf(n_chars: str) -> str:
        fields = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("d.doc_id", "source", "lang", n_chars, "text")]
        return f"sha256({' || '.join(fields)})"

    # the unsigned CRC-32 of a doc_id's digits, from its definition
    crc = f"""crc AS (
            SELECT doc_id, doc_id::VARCHAR AS s, 0 AS k, 4294967295::BIGINT AS c FROM documents
            UNION ALL
            SELECT doc_id, s, k + 1, list_reduce([xor(c, ascii(s[k + 1])::BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) FROM crc WHERE k < length(s))"""
    return f"""
        WITH RECURSIVE {crc},
        picked AS (SELECT DISTINCT doc_id FROM crc WHERE k = length(s) AND xor(c, 4294967295) % 7 = 0),
        l AS (
            SELECT d.doc_id, coalesce('=' || lang, '') AS g, {leaf("n_chars")} AS h,
                   CASE WHEN p.doc_id IS NOT NULL THEN {leaf("(n_chars + 1)")} END AS tampered
            FROM documents d LEFT JOIN picked p ON p.doc_id = d.doc_id),
        a AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, h) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM l),
        {levels("t1", "a")},
        s AS (SELECT g AS lang, '' AS g, h, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM t1 WHERE n = 1),
        {levels("t2", "s")},
        p1 AS ({proof("a", "t1", "doc_id")}), p2 AS ({proof("s", "t2", "lang")}),
        {folded("f1", "(SELECT doc_id, g, pos, n, coalesce(tampered, h) AS h FROM a)", "t1")},
        {folded("f2", "(SELECT f.doc_id, '' AS g, s.pos, s.n, f.h FROM f1 f JOIN s ON s.lang = f.g WHERE f.n = 1)", "t2")}
        SELECT a.doc_id, a.h AS leaf, s.h AS subroot, r.h AS root,
               sha256(coalesce(p1.proof, '') || coalesce(p2.proof, '')) AS proof_sha256, f2.h AS folded_root, f2.h = r.h AS verified
        FROM a JOIN s ON s.lang = a.g JOIN (SELECT h FROM t2 WHERE n = 1) r ON true
        LEFT JOIN p1 ON p1.doc_id = a.doc_id LEFT JOIN p2 ON p2.lang = a.g
        JOIN f2 ON f2.doc_id = a.doc_id AND f2.n = 1"""


ORACLE_SQL = {
    "op11_merkle_manifest": _merkle_sql(),
    "op12_collocations": rf"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
            FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
        t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
        g AS (
            {" UNION ALL ".join(f"SELECT lang, w[i : i + {k - 1}] AS ws, {k} AS size FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM p WHERE len(w) >= {k})" for k in (1, 2, 3))}),
        f AS (SELECT lang, ws, size, count(*) AS n FROM g GROUP BY ALL HAVING count(*) >= 10),
        c AS (SELECT lang, ws, size, n AS a, unnest(range(1, size)) AS k FROM f WHERE size > 1),
        s AS (
            SELECT c.lang, c.ws, c.size, a, k, x.n AS l, y.n AS r,
                   ((1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n))::BIGINT AS score
            FROM c JOIN f x ON x.lang = c.lang AND x.ws = c.ws[:k] JOIN f y ON y.lang = c.lang AND y.ws = c.ws[k + 1 :]),
        b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
        e AS (
            SELECT lang, ws[:2] AS ws, n FROM f WHERE size = 3 UNION ALL SELECT lang, ws[2:], n FROM f WHERE size = 3),
        o AS (SELECT lang, ws, max(n) AS longer FROM e GROUP BY ALL)
        SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, array_to_string(b.ws, ' ')) AS rank,
               array_to_string(b.ws, ' ') AS phrase, a, l, r, t.n, score
        FROM b JOIN t ON t.lang = b.lang LEFT JOIN o ON o.lang = b.lang AND o.ws = b.ws
        WHERE 100 * coalesce(longer, 0) < 50 * a QUALIFY rank <= 2000""",
    "op3_decontamination": _decontamination_sql(),
    "op2_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, first(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) = 1 AS kept, text_sha256
        FROM t""",
    "op5_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, pos, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM (SELECT doc_id, unnest(range(len(lines))) AS pos, unnest(lines) AS line
                  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
        k AS (SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        j AS (SELECT l.*, keeper IS NOT NULL AND doc_id <> keeper AS dropped FROM l LEFT JOIN k USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
        FROM j GROUP BY doc_id""",
    "op6_near_dedup": rf"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        s AS (
            SELECT DISTINCT doc_id, CASE WHEN len(ws) >= 5 THEN ws[i : i + 4] ELSE ws END AS shingle
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
        reach AS (
            SELECT doc_id AS d, doc_id AS r FROM documents
            UNION SELECT reach.d, l.b FROM reach JOIN l ON l.a = reach.r)
        SELECT d AS doc_id, coalesce(n, 0) AS n_shingles, min(r) AS component_id, d = min(r) AS kept
        FROM reach LEFT JOIN n ON n.doc_id = d GROUP BY d, n""",
}
