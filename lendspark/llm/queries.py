"""The corpus operators as queries over the shared test tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.llm import (
    chosen_path,
    grace,
    language_id,
    line_quality,
    main_text,
    merkle,
    packing,
    repeats,
    token_archive,
    token_counts,
    warc,
    whitening,
)
from lendspark.llm.mixing import Mix, mix_sources

# The vocabulary files of the machine, as their description names them.
TOKENIZER = "word_bpe_49k.json"

# Target shares of languages within each domain.
LANGUAGE_WEIGHTS = {(None, "en"): 0.4, (None, "de"): 0.2, (None, "fr"): 0.2, (None, "es"): 0.2}

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op8_quality_rules(spark, sf_dir):
    judged = line_quality.with_verdict(table(spark, sf_dir, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "words_left", "kept")


ORACLES["op8_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g
  FROM w, unnest(range(1, CAST(len(ws) AS BIGINT) - 6)) AS u(i)
), often AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win
), gaps AS (
  SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS gap
  FROM often WHERE c > 1
), repeats AS (
  SELECT doc_id, sum(gap) AS n FROM gaps GROUP BY doc_id
), base AS (
  SELECT w.doc_id, host, t, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN repeats USING (doc_id)
), line AS (
  SELECT DISTINCT host, t, trim(x) AS l FROM (
    SELECT host, t, unnest(string_split(regexp_replace(
      regexp_replace(lower(t), '[0-9]', '0', 'g'), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), chr(10))) AS x
    FROM d) WHERE trim(x) <> ''
), sizes AS (
  SELECT host, count(DISTINCT t) AS texts FROM line GROUP BY host
), frequent AS (
  SELECT host, l FROM line JOIN sizes USING (host) GROUP BY host, l, texts
  HAVING count(*) > greatest(20, texts * 2e-2)
), kept_words AS (
  SELECT line.host, t, sum(len(string_split(line.l, ' '))) AS total,
    sum(CASE WHEN frequent.l IS NULL THEN len(string_split(line.l, ' ')) ELSE 0 END) AS rest
  FROM line LEFT JOIN frequent ON line.host = frequent.host AND line.l = frequent.l
  GROUP BY line.host, t
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  CAST(CASE WHEN rest < total THEN rest END AS BIGINT) AS words_left,
  NOT base_failed AND coalesce(rest >= 3e-1 * total, TRUE) AS kept
FROM (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base) b
LEFT JOIN kept_words ON b.host = kept_words.host AND b.t = kept_words.t
"""


@query
def op9_exact_dedup(spark, sf_dir):
    return grace.groups(table(spark, sf_dir, "documents"))


ORACLES["op9_exact_dedup"] = """
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM (
  SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256,
    max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
    count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size
  FROM documents)
"""


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query
def op10_best_fit_packing(spark, sf_dir):
    packed = packing.pack(
        table(spark, sf_dir, "documents"), packing.Packing(tokenizer_path())
    )
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op2_minhash_near_dedup(spark, sf_dir):
    two_words = chosen_path.Join(words=2)
    groups = chosen_path.near_groups(table(spark, sf_dir, "documents"), settings=two_words)
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


ORACLES["op2_minhash_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, hash(CASE WHEN len(ws) = 1 THEN ws[1:1] ELSE ws[i:i + 1] END) AS g
  FROM w, unnest(range(1, greatest(2, CAST(len(ws) AS BIGINT)))) AS u(i) WHERE len(ws) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), overlap AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM overlap JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * c >= 80 * (p.n + q.n - c)
), reach(doc_id, to_id) AS (
  SELECT doc_id, doc_id FROM w
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN (SELECT a, b FROM link UNION ALL SELECT b, a FROM link) l
    ON l.a = r.to_id
)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""


def source_levels() -> list:
    """Domain, language and source of a document; sources of a domain differ by number."""
    return [F.regexp_extract("source", "^[^0-9]*", 0), F.col("lang"), F.col("source")]


@query
def op5_source_mixing(spark, sf_dir):
    mixed = mix_sources(
        table(spark, sf_dir, "documents"), source_levels(), Mix(weights=LANGUAGE_WEIGHTS)
    )
    return mixed.select("row.doc_id", "row.lang", "row.source", "epoch", "order")


@query
def op6_main_text(spark, sf_dir):
    return main_text.extract(table(spark, sf_dir, "pages"))


@query
def op4_language_id(spark, sf_dir):
    return language_id.predict(table(spark, sf_dir, "documents"))


@query
def op1_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("payload", "url")


ORACLES["op1_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages
), f AS (
  SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY h) ELSE page_id END AS first FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""


@query
def op3_token_counts(spark, sf_dir):
    # Id 49407 ends a document in this vocabulary.
    layout = token_counts.Layout(separator=49407)
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(), layout)


@query
def op7_suffix_dedup(spark, sf_dir):
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"), keep_first=False)
    left = F.make_valid_utf8(F.col("kept").cast("string"))
    return cut.withColumn("text", left).drop("kept")


@query
def op11_embedding_whitening(spark, sf_dir):
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


@query
def op12_merkle_manifest(spark, sf_dir):
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    one_more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("decimal(38,0)")
    tampered = merkle.leaf_digest([one_more if name == "n_chars" else F.col(name) for name in fields])
    chosen = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    documents = table(spark, sf_dir, "documents")
    rows = merkle.manifest(documents, fields, carry={"tampered": F.when(chosen, tampered)})
    checked = merkle.verified(rows.withColumn("claimed", F.coalesce("tampered", "leaf")), "claimed")
    text = lambda name: F.lower(F.hex(name)).alias(name)
    return checked.select(
        "doc_id",
        *[text(name) for name in ("leaf", "subroot", "root")],
        F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256"),
        text("folded_root"),
        "verified",
    )


ORACLES["op12_merkle_manifest"] = """
WITH RECURSIVE d AS (
  SELECT *, [
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'),
    coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-')] AS a,
    coalesce(strlen(text) || ':' || text, '-') AS z,
    xor(list_reduce(
      list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
      lambda r, x: list_reduce(range(8),
        lambda s, k: CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END, xor(r, x)),
      4294967295), 4294967295) % 7 = 0 AS tampered
  FROM documents
), leaves AS (
  SELECT doc_id, lang,
    sha256(array_to_string(a, '') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || z) AS leaf,
    sha256(array_to_string(a, '') || coalesce(strlen(CAST(n_chars + CAST(tampered AS INT) AS VARCHAR))
      || ':' || (n_chars + CAST(tampered AS INT)), '-') || z) AS claimed,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n
  FROM d
), tree(lang, level, i, n, h) AS (
  SELECT lang, 0, i, n, leaf FROM leaves
  UNION ALL
  SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM tree WHERE n > 1 GROUP BY lang, level, i // 2, n
), tops AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n
  FROM tree WHERE n = 1
), crown(level, i, n, h) AS (
  SELECT 0, i, n, h FROM tops
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM crown WHERE n > 1 GROUP BY level, i // 2, n
), beside AS (
  SELECT doc_id, 0 AS part, t.level, t.h FROM leaves l JOIN tree t
    ON t.lang IS NOT DISTINCT FROM l.lang AND t.i = xor(l.i >> t.level, 1)
  UNION ALL
  SELECT doc_id, 1, c.level, c.h FROM leaves l JOIN tops t ON t.lang IS NOT DISTINCT FROM l.lang
    JOIN crown c ON c.i = xor(t.i >> c.level, 1)
), proofs AS (
  SELECT doc_id, string_agg(h, '' ORDER BY part, level) AS proof FROM beside GROUP BY doc_id
), up(doc_id, lang, level, i, n, h) AS (
  SELECT doc_id, lang, 0, i, n, claimed FROM leaves
  UNION ALL
  SELECT doc_id, u.lang, u.level + 1, u.i // 2, (u.n + 1) // 2,
    sha256(CASE WHEN u.i % 2 = 1 THEN coalesce(b.h, '') || u.h ELSE u.h || coalesce(b.h, '') END)
  FROM up u LEFT JOIN (SELECT doc_id, level, h FROM beside WHERE part = 0) b USING (doc_id, level)
  WHERE u.n > 1
), over_top(doc_id, level, i, n, h) AS (
  SELECT doc_id, 0, t.i, t.n, u.h FROM up u JOIN tops t ON t.lang IS NOT DISTINCT FROM u.lang WHERE u.n = 1
  UNION ALL
  SELECT doc_id, o.level + 1, o.i // 2, (o.n + 1) // 2,
    sha256(CASE WHEN o.i % 2 = 1 THEN coalesce(b.h, '') || o.h ELSE o.h || coalesce(b.h, '') END)
  FROM over_top o LEFT JOIN (SELECT doc_id, level, h FROM beside WHERE part = 1) b USING (doc_id, level)
  WHERE o.n > 1
)
SELECT l.doc_id, leaf, t.h AS subroot, c.h AS root, sha256(coalesce(proof, '')) AS proof_sha256,
  o.h AS folded_root, o.h = c.h AS verified
FROM leaves l JOIN tops t ON t.lang IS NOT DISTINCT FROM l.lang
JOIN (SELECT h FROM crown WHERE n = 1) c ON TRUE
LEFT JOIN proofs USING (doc_id)
JOIN (SELECT doc_id, h FROM over_top WHERE n = 1) o USING (doc_id)
"""


@query
def op13_token_archive(spark, sf_dir):
    settings = token_archive.Archive(tokenizer_path("byte_bpe_50k.json"))
    return token_archive.round_trip(table(spark, sf_dir, "documents"), settings, keep_ids=False)
