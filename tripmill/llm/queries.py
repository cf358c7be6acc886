"""The registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

import string
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import ann, bpe, crosspolytope, fillmiddle, htmltext, langid, merkle, packing, pieces, pii, simhash, suffixdedup, warc
from tripmill.llm.common import table


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pii_key(spark: SparkSession) -> str:
    """The session's key, or the published one, which hides nothing and suits synthetic tables only."""
    key = spark.conf.get(pii.KEY_SETTING, None)
    if not key:
        warnings.warn(f"{pii.KEY_SETTING} is not set: pseudonyms under the published example key can be undone by anyone", stacklevel=2)
    return key or pii.EXAMPLE_KEY


def op1_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one by inner product."""
    vectors = table(spark, sf_dir, "embeddings")
    found = ann.search(vectors, vectors.where(F.col("vec_id") % 20 == 0))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, components and survivors of all vectors at cosine 0.98 within a label."""
    return crosspolytope.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best-fit-decreasing packing of all documents into sequences of 4096 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


def op4_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 64-bit fingerprints are linked at two bits or fewer."""
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' texts with personal data replaced by pseudonyms of the same format."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymize(docs, pii_key(spark), count="n_replaced")


def op6_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages into dictionary-compressed archives and read them back."""
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    docs = docs.select("doc_id", "text", "lang", held.alias("held_out"))
    model = langid.fit(docs.where(~F.col("held_out")))
    return langid.predict(docs, model, keep=["doc_id", "held_out"]).select("row.doc_id", "row.held_out", "lang_pred", "score", "n_langs", "odds")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of documents covered by 200-byte strings that occur more than once."""
    return suffixdedup.dedup(table(spark, sf_dir, "documents"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page."""
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op10_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document by the tokenization automaton."""
    return bpe.codec(table(spark, sf_dir, "documents"), vocabulary())


def op11_piece_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document by tables of distinct marked words."""
    return pieces.codec(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, with a check of each one's proof; a fifth are tampered with."""
    docs = table(spark, sf_dir, "documents")
    row = lambda text: merkle.digest_of(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars")), text)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    made = merkle.manifest(docs, row(F.col("text")), changed=F.when(hit, row(lower)))
    folded = merkle.fold(F.col("path"), F.coalesce("changed", "leaf"))
    made = made.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return made.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle form of every document, and the text rebuilt from it."""
    return fillmiddle.transform(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [f for name, f in globals().items() if name.startswith("op") and callable(f)]
    return {f.__name__: f for f in sorted(found, key=lambda f: int(f.__name__[2:].split("_")[0]))}


#: Levels of a tree in the SQL of the manifest: enough for 16^6 documents of a source.
_LEVELS = 6


def _tree_sql(name: str, leaves: str) -> str:
    """CTEs: {name}_k has (tree, i, d, n) of level k, k = 0 .. _LEVELS; a tree's single node stays as it is."""
    out = [f"{name}_0 AS ({leaves})"]
    for k in range(1, _LEVELS + 1):
        below = f"{name}_{k - 1}"
        out.append(f"{name}_{k} AS (SELECT tree, i // 16 AS i, CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d, (any_value(n) + 15) // 16 AS n FROM {below} GROUP BY tree, i // 16)")
    return ",\n".join(out)


def _steps_sql(name: str) -> str:
    """CTE {name}_up: of each leaf (tree, i), the joined digests before and after its node in every level's run (null where the tree has ended)."""
    runs = [f"{name}_r{k} AS (SELECT tree, i, n, string_agg(d, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b, string_agg(d, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS a FROM {name}_{k} WINDOW w AS (PARTITION BY tree, i // 16 ORDER BY i))" for k in range(_LEVELS)]
    sides = ", ".join(f"CASE WHEN r{k}.n > 1 THEN coalesce(r{k}.b, '') END AS b{k}, CASE WHEN r{k}.n > 1 THEN coalesce(r{k}.a, '') END AS a{k}" for k in range(_LEVELS))
    joins = " ".join(f"JOIN {name}_r{k} r{k} ON r{k}.tree IS NOT DISTINCT FROM l.tree AND r{k}.i = l.i // {16**k}" for k in range(_LEVELS))
    return ",\n".join([*runs, f"{name}_up AS (SELECT l.tree, l.i, {sides} FROM {name}_0 l {joins})"])


def _manifest_sql() -> str:
    field = lambda v: f"CASE WHEN {v} IS NULL THEN '-' ELSE CAST(strlen(CAST({v} AS VARCHAR)) AS VARCHAR) || ':' || CAST({v} AS VARCHAR) END"
    row = lambda text: "sha256(" + " || ".join([*map(field, ("doc_id", "source", "lang", "n_chars")), field(text)]) + ")"
    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    # SQL has no CRC-32; its table is made here, and the digits of an id are folded in
    crc = []
    for i in range(256):
        for _ in range(8):
            i = i >> 1 ^ 0xEDB88320 if i & 1 else i >> 1
        crc.append(i)
    hit = f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), lambda s, c: xor(s >> 8, list_extract({crc}::BIGINT[], (xor(s, c) & 255) + 1))), 4294967295::BIGINT) % 5 = 0"
    folds, at = [], "leaf_now"
    for t, k in [(t, k) for t in ("s", "t") for k in range(_LEVELS)]:
        step = f"f_{t}{k}"
        folds.append(f"{step} AS (SELECT * EXCLUDE (h), CASE WHEN {t}b{k} IS NULL THEN h ELSE sha256({t}b{k} || h || {t}a{k}) END AS h FROM {at})")
        at = step
    proof = " || ".join(f"coalesce({t}b{k} || {t}a{k}, '')" for t in ("s", "t") for k in range(_LEVELS))
    sides = ", ".join(f"{t}.b{k} AS {t}b{k}, {t}.a{k} AS {t}a{k}" for t in ("s", "t") for k in range(_LEVELS))
    return f"""
WITH leaves AS (SELECT doc_id, source AS tree, {row("text")} AS d, CASE WHEN {hit} THEN {row(lower)} ELSE {row("text")} END AS now FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, d) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
{_tree_sql("src", "SELECT tree, i, d, n FROM placed")},
subroots AS (SELECT tree AS name, d, row_number() OVER (ORDER BY encode(tree) NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM src_{_LEVELS}),
{_tree_sql("top", "SELECT '' AS tree, i, d, n FROM subroots")},
{_steps_sql("src")},
{_steps_sql("top")},
leaf_now AS (SELECT p.doc_id, p.d AS leaf, u.d AS subroot, r.d AS root, p.now AS h, {sides}
    FROM placed p JOIN src_up s ON s.tree IS NOT DISTINCT FROM p.tree AND s.i = p.i
    JOIN subroots u ON u.name IS NOT DISTINCT FROM p.tree JOIN top_up t ON t.i = u.i CROSS JOIN top_{_LEVELS} r),
{", ".join(folds)}
SELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, h AS folded_root, h = root AS verified FROM {at}
"""


SQL = {
    "op2_embedding_dedup": """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach(x, y) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
components AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
counted AS (SELECT x AS vec_id, count(*) AS n_links FROM links GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN counted USING (vec_id) JOIN components USING (vec_id)
""",
    "op6_warc_dictionary": """
WITH body AS (SELECT page_id, coalesce(html, '') AS b FROM pages),
hashed AS (SELECT page_id, strlen(b) AS size, sha1(b) AS h FROM body),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY h, size) AS first FROM hashed)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(((CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM firsts
""",
    "op12_merkle_manifest": _manifest_sql(),
    "op13_fill_in_middle": """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
numbers AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS y, CAST('0x' || h[17:24] AS BIGINT) % 100 AS z, CAST('0x' || h[25:32] AS BIGINT) % 100 AS w FROM drawn),
formed AS (SELECT doc_id, t, n, least(x, y) AS a, greatest(x, y) AS b,
    CASE WHEN t = '' OR regexp_matches(t, '<P>|<S>|<M>') OR z >= 90 THEN 'plain' WHEN w < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || left(t, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
        ELSE '<S>' || substr(t, b + 1) || '<P>' || left(t, a) || '<M>' || substr(t, a + 1, b - a) END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM formed
""",
}


def oracle_sql() -> dict[str, str]:
    """SQL has no collision counting, packing, XXH64 with a seed, Feistel networks, EM, byte strings of texts, cuts and BPE."""
    return dict(SQL)
