"""The operators of this package on the given tables.

Queries without SQL here depend on hashes, models or encodings that SQL does not
have; tests/llm holds them against brute force, exact round trips or held-out
labels.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from movecheck.llm.adaptive_scan import nearest_neighbours
from movecheck.llm.byte_bpe import round_trip
from movecheck.llm.chat_template import chat_digests
from movecheck.llm.exact_dedup import exact_duplicates
from movecheck.llm.gam import classify_quality
from movecheck.llm.gru_lm import score_documents
from movecheck.llm.license_scan import CONTAINED, LICENSES, SHINGLE, scan_licenses
from movecheck.llm.mixing import mix_sources
from movecheck.llm.orc_tokens import token_files
from movecheck.llm.quality_rules import quality_rules
from movecheck.llm.ranked_search import ranked_search
from movecheck.llm.simhash import near_duplicates
from movecheck.llm.token_alignment import aligned_tokens

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and robust outlier verdicts for every document."""
    return quality_rules(table(spark, sf_dir, "documents"))


@query
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, decoded again."""
    return round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    )


@query
def op10_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, as read back."""
    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found for every hundredth vector, among all vectors."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


@query
def op9_chat_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, read back from their formatted text."""
    return chat_digests(table(spark, sf_dir, "conversations"))


ORACLES["op9_chat_template"] = r"""
WITH turns AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL
  SELECT -7, v.turn, v.role, '\### Assistant: </turn> ok'
  FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)
), plain AS (
  SELECT conv_id, turn, role AS r, text AS t, coalesce(role, '') AS role, coalesce(text, '') AS text,
    length(replace(replace(replace(coalesce(text, ''), '\', '\\'), '<turn>', '\<turn>'), '</turn>', '\</turn>'))
    + length(replace(replace(replace(replace(coalesce(role, ''), '\', '\\'), '<turn>', '\<turn>'), '</turn>', '\</turn>'), chr(10), '\n'))
    AS escaped
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(escaped + length('<turn>' || chr(10) || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM plain GROUP BY conv_id
"""


# Which domain a source belongs to, by the number at the end of its name, and
# the weights of the mix.
DOMAINS = ("web", "books", "news", "forums")
WEIGHTS = {
    "domain": {"web": 4, "books": 3, "news": 2, "forums": 1},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
}


def with_domain(docs: DataFrame) -> DataFrame:
    number = F.coalesce(F.regexp_extract("source", r"(\d+)$", 1).try_cast("long"), F.lit(0))
    names = F.array(*[F.lit(name) for name in DOMAINS])
    return docs.withColumn("domain", names[F.pmod(number, len(DOMAINS)).cast("int")])


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the corpus's tokens, mixed to weights, each leaf twice at most."""
    docs = with_domain(table(spark, sf_dir, "documents"))
    return mix_sources(docs, WEIGHTS, F.col("total") / 2, max_epochs=2, seed=1)


def _shared_sql(parents: list[str], name: str, children: str) -> str:
    """The children's budgets: supplies first where they are short, then by weight."""
    by = f"PARTITION BY {', '.join(parents)}" if parents else ""
    order = f"{by} ORDER BY supply / weight, weight, {name} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    return f"""(
      SELECT * EXCLUDE (budget), CASE WHEN place >= stop THEN
               CAST((rest * upto) // open_weight - (rest * (upto - weight)) // open_weight AS BIGINT) ELSE supply END AS budget
      FROM (
        SELECT *, MAX(CASE WHEN place = stop THEN budget - before END) OVER ({by}) AS rest,
               MAX(CASE WHEN place = stop THEN weight_left END) OVER ({by}) AS open_weight,
               SUM(CASE WHEN place >= stop THEN weight END) OVER ({order}) AS upto
        FROM (
          SELECT *, MIN(place) FILTER (CAST(supply AS HUGEINT) * weight_left > CAST(weight AS HUGEINT) * (budget - before)) OVER ({by}) AS stop
          FROM (
            SELECT *, SUM(supply) OVER ({order}) - supply AS before, ROW_NUMBER() OVER ({order}) AS place,
                   SUM(weight) OVER ({by}) - SUM(weight) OVER ({order}) + weight AS weight_left
            FROM ({children})))))"""


def _weight_sql(level: str) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {weight}" for name, weight in WEIGHTS.get(level, {}).items())
    return f"CASE {level} {cases} ELSE 1 END" if cases else "1"


def mix_sql(epochs: int, seed: int) -> str:
    """The mix of half the tokens: the tree level by level, then each leaf's prefix as a running sum."""
    levels = ("domain", "lang", "source")
    above, text = "(SELECT CAST(SUM(tokens) // 2 AS BIGINT) AS budget FROM leaves)", ""
    for i, level in enumerate(levels):
        keys, same = list(levels[: i + 1]), " AND ".join(f"s.{k} IS NOT DISTINCT FROM u.{k}" for k in levels[:i]) or "TRUE"
        children = f"""
          SELECT s.*, u.budget FROM (
            SELECT {", ".join(keys)}, SUM(tokens) AS tokens, SUM(tokens) * {epochs} AS supply, {_weight_sql(level)} AS weight
            FROM leaves GROUP BY {", ".join(keys)}) s JOIN {above} u ON {same}"""
        text += f", level{i} AS {_shared_sql(list(levels[:i]), level, children)}"
        above = f"level{i}"
    domains = ", ".join(f"'{name}'" for name in DOMAINS)
    return rf"""
    WITH docs AS (
      SELECT doc_id, [{domains}][1 + COALESCE(TRY_CAST(regexp_extract(source, '(\d+)$', 1) AS BIGINT), 0) % {len(DOMAINS)}] AS domain,
             lang, source, CAST(len(regexp_extract_all(text, '[^ 	-]+')) AS BIGINT) AS n_tokens FROM documents
    ), counted AS (SELECT * FROM docs WHERE n_tokens > 0),
    leaves AS (SELECT domain, lang, source, SUM(n_tokens) AS tokens FROM counted GROUP BY ALL){text},
    placed AS (
      SELECT c.*, CAST(budget // tokens AS BIGINT) AS copies, budget % tokens AS rest,
             md5('{seed}:' || CAST(CAST(budget // tokens AS BIGINT) AS VARCHAR) || ':' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS mark
      FROM counted c JOIN level2 l ON c.domain = l.domain AND c.lang IS NOT DISTINCT FROM l.lang AND c.source IS NOT DISTINCT FROM l.source
    ), taken AS (
      SELECT *, rest - (SUM(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY mark, n_tokens
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n_tokens) AS room FROM placed
    )
    SELECT doc_id, domain, lang, source, n_tokens, copies, CAST(GREATEST(0, LEAST(n_tokens, room)) AS BIGINT) AS n_partial
    FROM taken WHERE copies > 0 OR room > 0
    """


ORACLES["op3_mix_sources"] = mix_sql(epochs=2, seed=1)


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses found in every document."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def license_sql(templates: tuple[tuple[str, str], ...], contained: float) -> str:
    """Every place where a shingle of a template stands, with the template's share around it."""
    quote = chr(39)
    values = ", ".join(
        f"({i}, {quote}{name}{quote}, {quote}{text.replace(quote, quote * 2)}{quote})" for i, (name, text) in enumerate(templates)
    )

    def shingles(rows: str) -> str:
        words = "string_split_regex(lower(trim(coalesce(text, ''), ' .' || chr(10))), '[\\x00-\\x2f\\x3a-\\x40\\x5b-\\x60\\x7b-\\x7f]+')"
        return f"""
          SELECT * EXCLUDE (w), array_to_string(w[place + 1 : place + {SHINGLE}], ' ') AS s
          FROM (SELECT * EXCLUDE (text), {words} AS w, unnest(range(len({words}) - {SHINGLE - 1})) AS place FROM {rows})"""

    return f"""
    WITH wanted AS ({shingles(f"(SELECT * FROM (VALUES {values}) v(template, license, text))")}),
    sizes AS (SELECT template, license, COUNT(*) AS size, COUNT(DISTINCT s) AS kinds, CAST(CEIL(COUNT(*) / 4) AS BIGINT) AS slack
              FROM wanted GROUP BY ALL),
    found AS ({shingles("(SELECT doc_id, text FROM documents)")}),
    hits AS (SELECT doc_id, template, f.place, f.place - w.place AS start, f.s FROM found f JOIN wanted w USING (s)),
    starts AS (SELECT DISTINCT doc_id, template, start FROM hits),
    shares AS (
      SELECT b.doc_id, z.license, COUNT(DISTINCT h.s) / z.kinds AS containment
      FROM starts b JOIN sizes z USING (template)
      JOIN hits h ON h.doc_id = b.doc_id AND h.template = b.template
        AND h.place BETWEEN GREATEST(b.start - z.slack, 0) AND b.start + z.size + z.slack - 1
      GROUP BY b.doc_id, b.template, b.start, z.license, z.kinds)
    SELECT doc_id, license, MAX(containment) AS containment FROM shares WHERE containment >= {contained} GROUP BY ALL
    """


ORACLES["op4_license_scan"] = license_sql(LICENSES, CONTAINED)


@query
def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and network likelihood of every document."""
    return score_documents(table(spark, sf_dir, "documents"))


@query
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one of its equals that stays."""
    return exact_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op13_exact_dedup"] = r"""
WITH bare AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents
), ranked AS (
  SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id,
    count(*) OVER (PARTITION BY content) AS group_size
  FROM bare WINDOW w AS (PARTITION BY content ORDER BY n DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(content) AS text_sha256 FROM ranked
"""


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents for every benchmark item."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_ranked_search"] = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY doc_id),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths),
marked AS (SELECT doc_id, 75 + ((25 * n * n_docs) // n_terms) AS m FROM lengths, totals),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, totals GROUP BY term, n_docs
), asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY ALL
), scores AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN marked USING (doc_id)
  GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 20
"""


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers in every document, with corpus-wide link counts."""
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return aligned_tokens(table(spark, sf_dir, "documents"), *paths)
