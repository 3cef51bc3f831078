"""Registered queries of the operators, with DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally.llm import chat_format, exact_dedup, fill_middle, langid, mixing, packing, quality_gam, simhash, substring_dedup, token_files, topk, toxicity, vector_codes
from tally.llm.common import unsigned_hex
from tally.plans.registry import query
from tally.session import cut_lineage, scratch_path
from tally.sources.io import Tables


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_MARKED = r"([<\[])(\\*)(s>|INST\]|/INST\]|ANS\]|/s>)"

_OP1_SQL = rf"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS who, coalesce(text, '') AS what FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
    SELECT *, length(regexp_replace(who, '{_MARKED}', '\1\\\2\3', 'g')) + length(regexp_replace(what, '{_MARKED}', '\1\\\2\3', 'g'))
        + CASE WHEN who = 'assistant' THEN 12 ELSE 16 END AS written
    FROM said
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(who || chr(10) || what || chr(10), '' ORDER BY turn NULLS FIRST, who, what)) AS turns_sha256,
    CAST(coalesce(sum(length(what)) FILTER (WHERE who = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(what, '' ORDER BY turn NULLS FIRST, what) FILTER (WHERE who = 'assistant'), '')) AS loss_sha256,
    CAST(sum(written) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


def op1_chat_format(t: Tables):
    """Digests of all conversations (and conversation -1, which holds control strings), read back from ids and masks."""
    probe = t.spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string")
    rows = t.conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
    path = tokenizer_path()
    return chat_format.read_back(chat_format.format_turns(rows, path), path)


def op2_quality_gam(t: Tables):
    """Quality score of every document; labels of two folds of three are learned."""
    known = cut_lineage(quality_gam.with_figures(t.documents))
    learned = t.labels.where(quality_gam.remainder("doc_id", 3) != 1)
    model = quality_gam.fit_labelled(known, learned, "quality")
    return quality_gam.score(known, model).select("doc_id", (quality_gam.remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_best_fit_packing(t: Tables):
    """All documents as pieces in sequences of at most 1024 tokens."""
    return packing.pack(t.documents, tokenizer_path()).drop("row")


def op4_mix_sources(t: Tables):
    """What a mix of 150 % of all words takes of each document."""
    return mixing.mix(t.documents).select("doc_id", "size", "source_size", "target", "taken")


_OP5_SQL = """
WITH whole AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.r, q.vec_id AS query_id, d.vec_id,
        CAST(list_sum(list_transform(range(1, least(len(q.v), len(d.v)) + 1), lambda i: q.v[i] * d.v[i])) AS BIGINT) AS score
    FROM whole q JOIN whole d ON q.r <> d.r WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op5_topk_blocks(t: Tables):
    """Five best integer inner products of every fiftieth vector with all other rows."""
    vectors = topk.scaled(t.embeddings)
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP6_SQL = f"""
WITH plain AS (SELECT doc_id, {_LOWER} AS low FROM documents),
named AS (SELECT doc_id, sha256(low) AS text_sha256, max(doc_id) OVER (PARTITION BY low) AS keep_id, count(*) OVER (PARTITION BY low) AS group_size FROM plain)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM named
"""


def op6_exact_dedup(t: Tables):
    """Every document with the document that stays for its text."""
    return exact_dedup.exact_dedup(t.documents).drop("row")


def op7_language_id(t: Tables):
    """Language of every document; four folds of five are learned."""
    held_out = quality_gam.remainder("doc_id", 5) == 0
    model = langid.fit(t.documents.where(~held_out))
    return langid.predict(t.documents, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_toxicity_mil(t: Tables):
    """Toxicity score of every document, its worst sentence and every offending one; labels of three folds of four are learned."""
    held_out = quality_gam.remainder("doc_id", 4) == 2
    model = toxicity.fit_labelled(t.documents, t.labels.where(~held_out), "toxic")
    found = toxicity.score(t.documents, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "worst_start", "worst_end", "worst_score", "n_offending", "offending")


def op9_simhash_covering(t: Tables):
    """SimHash component of every document: three-word shingles, links at two or fewer differing bits."""
    docs = t.documents.withColumn("row", F.monotonically_increasing_id())
    found = simhash.near_duplicates(docs, words_per_shingle=3, radius=2, id_col="row")
    return found.select("doc_id", unsigned_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op10_substring_dedup(t: Tables):
    """Spans of 40 words or more that other documents hold too, found by chunks defined by content."""
    spans = substring_dedup.repeated_spans(t.documents, min_words=40)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return spans.select("doc_id", "span_start", "span_bytes", "span_words", "n_chunks", "copies", "first_doc_id", removed.alias("removed_bytes"))


_OP11_SQL = """
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS x, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), numbers AS (
    SELECT *, length(x) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
        CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
    FROM hashed
), formed AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 90 THEN 'plain'
            WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers
), cut AS (
    SELECT *, substr(x, 1, a) AS p, substr(x, a + 1, b - a) AS m, substr(x, b + 1) AS s FROM formed
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
    CAST(CASE WHEN form <> 'plain' THEN a END AS BIGINT) AS prefix_chars,
    CAST(CASE WHEN form <> 'plain' THEN b - a END AS BIGINT) AS middle_chars,
    sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE x END) AS output_sha256,
    sha256(x) AS restored_sha256
FROM cut
"""


def op11_fill_in_middle(t: Tables):
    """Every document cut into prefix, middle and suffix of code points, with digests of the output and of the text restored from it."""
    made = fill_middle.fill_in_middle(t.documents)
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


def _op12_sql(rounds: int = 6) -> str:
    """Rounds of assignment and means as one relation each, a row per component."""

    def assigned(i: int) -> str:
        return f"""
), far{i} AS (
    SELECT c.r, c.part, b.entry, sum((c.x - b.e) * (c.x - b.e)) AS d FROM cells c JOIN book{i} b USING (part, pos) GROUP BY ALL
), near{i} AS MATERIALIZED (
    SELECT r, part, min(d) AS d, min(d * 256 + entry) % 256 AS entry FROM far{i} GROUP BY ALL"""

    sql = """
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS r, vec_id, label, v
    FROM (SELECT vec_id, label, embedding, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
), wide AS (SELECT max(len(v)) // 8 AS w FROM kept
), cells AS MATERIALIZED (
    SELECT r, (i - 1) // w AS part, (i - 1) % w AS pos, v[i] AS x FROM (SELECT r, v, w, unnest(range(1, 8 * w + 1)) AS i FROM kept, wide)
), book0 AS (SELECT part, r AS entry, pos, x AS e FROM cells WHERE r < 16"""
    for i in range(rounds):
        sql += assigned(i) + f"""
), mean{i} AS (
    SELECT n.part, n.entry, c.pos, sum(c.x) AS s, count(*) AS n FROM near{i} n JOIN cells c USING (r, part) GROUP BY ALL
), book{i + 1} AS MATERIALIZED (
    SELECT b.part, b.entry, b.pos, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, b.e) AS e
    FROM book{i} b LEFT JOIN mean{i} m ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos"""
    sql += assigned(rounds) + f"""
), coded AS (
    SELECT r, string_agg(printf('%02x', CAST(entry AS INT)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(CAST(e AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (r)"""
    return sql


def op12_vector_codes(t: Tables):
    """Code of every vector in eight parts of sixteen entries, its squared error, that of its label, and the digest of the codebooks."""
    vectors, width = vector_codes.whole_vectors(t.embeddings, keep=("label",))
    books = vector_codes.fit(vectors, width)
    coded = cut_lineage(vector_codes.encode(vectors, books, keep=("label",)))
    of_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    found = coded.join(of_label, coded["label"].eqNullSafe(of_label["of"]))
    return found.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op13_token_files(t: Tables):
    """Place, number and checksum of every document's token ids, read back from sorted ORC files."""
    path = scratch_path(t.spark)
    token_files.write_tokens(t.documents, path, tokenizer_path())
    return token_files.checksums(token_files.read_tokens(t.spark, path))


_ALL = {
    op1_chat_format: _OP1_SQL,
    op2_quality_gam: None,
    op3_best_fit_packing: None,
    op4_mix_sources: None,
    op5_topk_blocks: _OP5_SQL,
    op6_exact_dedup: _OP6_SQL,
    op7_language_id: None,
    op8_toxicity_mil: None,
    op9_simhash_covering: None,
    op10_substring_dedup: None,
    op11_fill_in_middle: _OP11_SQL,
    op12_vector_codes: _op12_sql(),
    op13_token_files: None,
}


def register() -> None:
    for fn, sql in _ALL.items():
        query(fn.__name__, sql)(fn)
