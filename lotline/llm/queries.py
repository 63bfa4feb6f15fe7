"""One query per operator, over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotline.llm import bpe, chat, exact_dedup, language, line_dedup, mixing, pii, prefix_trie, quality, simhash, token_count, url_filter, vector_codes

#: Where the tokenizers' files lie (a parameter of the operators; read on the driver only).
VOCABULARY, PIECES = "word_bpe_49k.json", "piece_bpe_32k.model"
#: The rules (host, path, verdict) of the URL query.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Key of the pseudonyms in the query; a user gives a secret one.
PII_KEY = "example key"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = VOCABULARY) -> str:
    """JSON text of a public tokenizer."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def pieces(name: str = PIECES) -> bytes:
    """Model of a public tokenizer."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-dedup of ``documents``: 3-word shingles, XXH64 with seed 42, links at 2 bits."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), width=3, seed=42, radius=2)
    return found.select("doc_id", "fingerprint", "component_id")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix of all ``documents``: weights 5, 2, 1, 150 % of all words, at most two epochs of a source."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, max_epochs=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over ``documents``: base counts and compression bands."""
    judged = quality.quality(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup of ``documents``: per document its dropped lines, equal to or one word from an earlier one."""
    return line_dedup.line_counts(_table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` with its personal values replaced by pseudonyms."""
    out = pii.pseudonymise(_table(spark, sf_dir, "documents"), key=PII_KEY)
    return out.select("doc_id", "text", *[f"n_{k}" for k in pii.KINDS])


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` encoded and decoded."""
    return bpe.encode(_table(spark, sf_dir, "documents"), vocabulary(), keep=["doc_id"], with_ids=False)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every URL of ``pages``: rules, and for the rest trees trained from the URLs that the rules label."""
    pages = _table(spark, sf_dir, "pages")
    model = url_filter.train(url_filter.labelled_by_rules(pages, RULES))
    return url_filter.filter_urls(pages, RULES, model)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of ``documents``: of equal texts the largest doc_id stays."""
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"), keep="largest")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text of ``documents``, learned from the rows that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = language.train(docs.filter(~language.held_out("doc_id")))
    said = language.identify(docs.select("doc_id", "text"), model)
    return said.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message of ``conversations`` without quotes, linked to what it quotes, in reply order."""
    return chat.format_chats(_table(spark, sf_dir, "conversations"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all ``embeddings``: 4 parts, 256 entries, 4 rounds."""
    coded = vector_codes.compress(_table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all ``conversations``, each begun like the first one of its group of five."""
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"), openings=5)


def op13_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text of ``documents``; over the limit from 4,097 on."""
    return token_count.count_tokens(_table(spark, sf_dir, "documents"), pieces(), keep=["doc_id"], limit=4096)


def registry() -> dict:
    return {f.__name__: f for f in (
        op1_simhash, op2_mixing, op3_quality, op4_line_dedup, op5_pii, op6_bpe, op7_url_filter, op8_exact_dedup, op9_language, op10_chat_format,
        op11_vector_codes, op12_prefix_trie, op13_token_count)}


OP2 = r"""
WITH s AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM s GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM src),
lv AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(2 * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW f AS (ORDER BY 2 * source_size / w::DOUBLE, source NULLS LAST)),
t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, max(level) OVER () * w) AS target FROM lv),
g AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(CAST(round(target) AS BIGINT) / source_size::DOUBLE) AS BIGINT) ELSE 0 END AS whole,
         CAST(round(target) AS BIGINT) AS goal FROM t),
c AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.whole, g.goal - g.whole * g.source_size AS rest,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM s JOIN g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, CAST(whole * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM c
"""

OP8 = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


def _op11_sql(rounds: int = 4) -> str:
    """Each round as two tables: nearest entries by distance and index, and the entries moved."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
n{r} AS MATERIALIZED (
  SELECT vec_id, label, part, x, min(struct_pack(d := d, entry := entry)) AS best
  FROM (SELECT v.*, e.entry, list_sum(list_transform(list_zip(v.x, e.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM v JOIN e{r} e USING (part)) GROUP BY ALL)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (
  SELECT part, entry, list(m ORDER BY pos) AS x FROM (
    SELECT part, best.entry AS entry, pos, CAST(floor(sum(x[pos]) / count(*)::DOUBLE) AS BIGINT) AS m
    FROM n{r}, (SELECT unnest(generate_series(1, (SELECT max(len(x)) FROM v))) AS pos) GROUP BY ALL) GROUP BY ALL),
e{r + 1} AS MATERIALIZED (SELECT e.part, e.entry, coalesce(m.x, e.x) AS x FROM e{r} e LEFT JOIN m{r} m USING (part, entry))""")
    return f"""
WITH k AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(1024 * c::DOUBLE) AS BIGINT)) AS c FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
v AS MATERIALIZED (
  SELECT vec_id, label, part, c[part * len(c) // 4 + 1 : (part + 1) * len(c) // 4] AS x FROM k, (SELECT unnest([0, 1, 2, 3]) AS part)),
e0 AS MATERIALIZED (
  SELECT part, entry, x FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM v) WHERE entry < 256),
{",".join(steps).strip()},
h AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM e{rounds}),
c AS (
  SELECT vec_id, label, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM n{rounds} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM c, h
"""


# a conversation's turns as one string, each with its lengths in front, so that prefixes of turns are prefixes of strings
OP12 = """
WITH o AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, '')))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (
  SELECT DISTINCT c, c - c % 5 AS b,
         xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::UBIGINT),
           lambda a, x: list_reduce([xor(a, x)] || [0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT],
             lambda v, z: xor(v >> 1, 3988292384::UBIGINT * (v & 1)))), 4294967295::UBIGINT) % 9 AS h
  FROM o),
t AS (
  SELECT n.c, o.i, o.role, o.text FROM n JOIN o ON o.c = n.b AND o.i <= n.h
  UNION ALL SELECT n.c, o.i, o.role, o.text FROM n JOIN o ON o.c = n.c AND o.i > n.h),
d AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY i) AS depth FROM t),
p AS (
  SELECT c, depth, octet_length(encode(text)) AS bytes,
         string_agg(concat('|', length(role), ',', length(text), ':', role, text), '' ORDER BY depth) OVER (PARTITION BY c ORDER BY depth) AS path,
         coalesce(string_agg(concat('|', length(role), ',', length(text), ':', role, text), '' ORDER BY depth)
           OVER (PARTITION BY c ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS up,
         depth = count(*) OVER (PARTITION BY c) AS last
  FROM d
  UNION ALL SELECT c, 0, 0, '', NULL, c NOT IN (SELECT c FROM d) FROM n),
g AS MATERIALIZED (
  SELECT path, any_value(up) AS up, any_value(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
  FROM p GROUP BY path),
k AS (SELECT up AS path, count(*) AS n_children FROM g WHERE up IS NOT NULL GROUP BY up),
m AS MATERIALIZED (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN k USING (path)),
s AS (
  SELECT a.path, CAST(sum(CAST(b.n_children = 0 AS BIGINT)) AS BIGINT) AS n_leaves, CAST(sum(b.saved) AS BIGINT) AS saved_tokens
  FROM m a JOIN m b ON b.depth >= a.depth AND starts_with(b.path, a.path) GROUP BY a.path)
SELECT m.conv_id, CAST(m.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves, s.saved_tokens, m.ends_sha256
FROM m JOIN s USING (path) LEFT JOIN m u ON u.path = m.up
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_mixing": OP2, "op8_exact_dedup": OP8, "op11_vector_codes": _op11_sql(), "op12_prefix_trie": OP12}
