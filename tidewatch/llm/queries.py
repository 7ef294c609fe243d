"""One query per operator, over whole tables, and SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.llm import bpe, chat, decontam, exact, html, langid, mixing, neardup, phrases, pii, quality, resample, substring


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def q_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    found = exact.exact_dedup(docs, carry=[F.col("doc_id"), digest])
    return found.select("row.doc_id", "keep_id", "group_size", "kept", "row.text_sha256")


def q_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find_pii(docs, pii.fit(docs))


def q_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def q_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def fold(modulus: int, column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string")) % modulus


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), fold(3) != 1)
    held_out = F.coalesce(fold(3) == 1, F.lit(False))
    return quality.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def q_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = langid.fit(docs, fold(5) != 0)
    held_out = F.coalesce(fold(5) == 0, F.lit(False))
    return langid.predict(docs, net).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def q_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def q_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


def q_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # Only the length of a text is needed, so the text itself is not shuffled.
    light = docs.select("doc_id", "source", F.length("text").alias("n_code_points"))
    mixed = mixing.mix_sources(light, volume=F.col("row.n_code_points"))
    return mixed.select(F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), "block", "slot", "on_target")


def q_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], turns.schema)
    return chat.read_back(chat.format_chat(turns.unionByName(probe)))


def q_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = bpe.decode(bpe.encode(docs, path), path)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def q_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def q_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample.resample(docs, table(spark, sf_dir, "benchmark")).drop("n_words")


_MIX_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '' ELSE 's' || source END AS src,
         coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         CAST(greatest(coalesce(length(text), 0), 1) AS BIGINT) AS vol
  FROM documents),
ahead AS (
  SELECT *, CAST(coalesce(sum(vol) OVER (PARTITION BY src ORDER BY md5(id), id, vol
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) // {mixing.BLOCK_CHARS} AS block
  FROM docs),
sizes AS (SELECT src, CAST(sum(vol) AS BIGINT) AS vol, CAST(floor(sqrt(CAST(sum(vol) AS DOUBLE))) AS BIGINT) AS w FROM docs GROUP BY src),
parts AS (SELECT src, vol, CAST(greatest(({mixing.PARTS} * w) // CAST(sum(w) OVER () AS BIGINT), 1) AS BIGINT) AS q FROM sizes),
quota AS (SELECT *, CAST(sum(q) OVER () AS BIGINT) AS cycle FROM parts),
needed AS (SELECT least(max(cycle), max((((vol - 1) // {mixing.BLOCK_CHARS} + 1) * cycle + q - 1) // q)) AS slots FROM quota),
steps AS (
  SELECT CAST(-1 AS BIGINT) AS t, src, q, cycle, CAST(0 AS BIGINT) AS taken, false AS won FROM quota
  UNION ALL
  SELECT t + 1, src, q, cycle, taken + CASE WHEN pick THEN 1 ELSE 0 END, pick FROM (
    SELECT *, taken * cycle < (t + 2) * q AND row_number() OVER (ORDER BY
             CASE WHEN taken * cycle < (t + 2) * q THEN 0 ELSE 1 END,
             ((taken + 1) * cycle + q - 1) // q, src) = 1 AS pick
    FROM steps WHERE t + 1 < (SELECT slots FROM needed))),
plan AS (SELECT src, taken - 1 AS nth, t AS slot FROM steps WHERE won),
last AS (
  SELECT min(((vol - 1) // {mixing.BLOCK_CHARS} // q) * cycle + slot) AS fin
  FROM quota JOIN plan USING (src) WHERE nth = ((vol - 1) // {mixing.BLOCK_CHARS}) % q),
placed AS (
  SELECT doc_id, source, block, (block // q) * cycle + slot AS slot
  FROM ahead JOIN quota USING (src) JOIN plan ON plan.src = ahead.src AND plan.nth = ahead.block % q)
SELECT doc_id, source, block, CAST(slot AS BIGINT) AS slot, slot <= (SELECT fin FROM last) AS on_target FROM placed
"""

_EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# Turns and texts that are read back unchanged can be told from the table alone; the length of the
# formatted text follows from the template and the texts, which hold no control strings but in the probe.
_CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
         lag(turn) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS turn_before FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + length(text) + 24
           + CASE WHEN conv_id = -7 THEN 3 ELSE length(text) - length(replace(text, '\', '')) END) AS BIGINT) AS formatted_chars,
       bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user')
                     WHEN before IN ('system', 'assistant') THEN role = 'user'
                     WHEN before = 'user' THEN role = 'assistant' ELSE false END
                AND turn_before IS DISTINCT FROM turn)
         AND arg_max(role, turn) IN ('user', 'assistant') AS valid
FROM marked GROUP BY conv_id
"""


_WORD = r"[^\x20\x09-\x0D]+"

_NEAR_SQL = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM texts),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM sets a JOIN sets b USING (s) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM common JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v WHERE 100 * c >= 80 * (a.n + b.n - c)),
edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, edges.v FROM reach JOIN edges ON reach.r = edges.u),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM least LEFT JOIN sizes USING (doc_id)
"""

_REPEATS_SQL = rf"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + {substring.WINDOW - 1}], ' ') AS s
  FROM texts, unnest(range(1, len(w) - {substring.WINDOW - 2})) AS t(i)),
repeated AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {substring.WINDOW})) AS p FROM windows SEMI JOIN repeated USING (s)),
placed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM texts),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS kept FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""


_PHRASES_SQL = rf"""
WITH texts AS (
  SELECT coalesce(lang, '{phrases.UNKNOWN}') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM texts),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM pieces, unnest(range(1, {phrases.LONGEST + 1})) AS s(size), unnest(range(1, len(w) - size + 2)) AS t(i)),
freq AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {phrases.LEAST}),
cands AS (SELECT *, string_split(phrase, ' ') AS w FROM freq WHERE size > 1),
inside AS (
  SELECT c.lang, array_to_string(c.w[i:i + s - 1], ' ') AS phrase, max(c.f) AS most
  FROM cands c, unnest(range(2, c.size)) AS a(s), unnest(range(1, c.size - s + 2)) AS b(i) GROUP BY ALL),
kept AS (SELECT c.* FROM cands c LEFT JOIN inside USING (lang, phrase) WHERE most IS NULL OR 100 * most < {phrases.WITHIN} * f),
cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
  FROM kept, unnest(range(1, size)) AS t(k)),
scored AS (
  SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r, n,
         CAST((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cuts c JOIN freq l ON l.lang = c.lang AND l.phrase = head JOIN freq r ON r.lang = c.lang AND r.phrase = rest
       JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= {phrases.TOP}
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii": q_pii,
        "op2_quality": q_quality,
        "op3_main_text": q_main_text,
        "op4_near_duplicates": q_near_duplicates,
        "op5_benchmark_leaks": q_benchmark_leaks,
        "op6_language": q_language,
        "op7_substring_dedup": q_substring_dedup,
        "op8_exact_dedup": q_exact_dedup,
        "op9_mix_sources": q_mix_sources,
        "op10_chat_format": q_chat_format,
        "op11_bpe": q_bpe,
        "op12_phrases": q_phrases,
        "op13_resample": q_resample,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_near_duplicates": _NEAR_SQL,
        "op7_substring_dedup": _REPEATS_SQL,
        "op8_exact_dedup": _EXACT_SQL,
        "op9_mix_sources": _MIX_SQL,
        "op10_chat_format": _CHAT_SQL,
        "op12_phrases": _PHRASES_SQL,
    }
