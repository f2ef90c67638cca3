"""The registered queries of the training-data operators."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from tillroll.llm import bestfit, divergence, fingerprints, forest, langid, neardup, packing, pieces, quality, secrets, toxicity, urlfilter, variants
from tillroll.llm.batches import held_out, learnable
from tillroll.session import ship, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        @functools.wraps(run)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return run(spark, sf_dir)

        QUERIES[name] = shipped
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dated(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Captures and list entries of the pages: dates and actions come from the digest of the URL.

    About a third of the pages each add an event for their host, host's domain, first path segment or URL.
    """
    number = lambda at: F.conv(F.substring("h", at, 4), 16, 10).cast("int")
    rows = pages.select("page_id", "url", F.md5("url").alias("h")).withColumn("host", urlfilter.host(F.col("url")))
    day = F.date_add(F.lit("2024-01-01").cast("date"), number(1) % 730)
    captures = rows.select("page_id", "url", day.alias("fetched_on"))
    kind, sort = F.substring("h", 5, 1), F.substring("h", 6, 1)
    labels = F.split("host", r"\.")
    key = (
        F.when(kind < "2", F.concat(F.lit("d:"), "host"))
        .when(kind == "2", F.concat(F.lit("p:"), "host", F.lit("/"), F.get(urlfilter.segments(F.col("url")), 0)))
        .when(kind == "3", F.concat(F.lit("u:"), "url"))
        .when(kind == "4", F.concat(F.lit("d:"), F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")))
    )
    action = F.when(sort < "8", "block").when(sort < "b", "allow").otherwise("remove")
    listed = F.date_add(F.lit("2023-06-01").cast("date"), number(7) % 900)
    entries = rows.where("host <> ''").select(key.alias("key"), action.alias("action"), listed.alias("listed_on"))
    return captures, entries.where("key is not null")


_OP1_SQL = r"""
with rows_ as (
  select page_id, url, md5(url) as h,
    lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)', 1)) as host,
    list_filter(string_split(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') as parts
  from pages),
captures as (
  select page_id, url, host, parts, string_split(host, '.') as labels,
    (date '2024-01-01' + (cast('0x' || substr(h, 1, 4) as integer) % 730)) as fetched_on from rows_),
listed as (
  select case when substr(h, 5, 1) < '2' then 'd:' || host
      when substr(h, 5, 1) = '2' then 'p:' || host || '/' || parts[1]
      when substr(h, 5, 1) = '3' then 'u:' || url
      when substr(h, 5, 1) = '4' then 'd:' || array_to_string(string_split(host, '.')[-2:], '.') end as key,
    case when substr(h, 6, 1) < '8' then 3 when substr(h, 6, 1) < 'b' then 2 else 1 end as level,
    date '2023-06-01' + (cast('0x' || substr(h, 7, 4) as integer) % 900) as day
  from rows_ where host <> ''),
events as (select key, day, max(level) as level from listed where key is not null group by all),
spans as (
  select * from (select key, level, day as valid_from, lead(day) over (partition by key order by day) as valid_to from events)
  where level > 1),
asked as (
  select distinct url, fetched_on, unnest(list_concat(list_concat(
    list_transform(range(1, len(labels) + 1), lambda i: {'key': 'd:' || array_to_string(labels[i:], '.'), 'rank': len(labels) - i + 1}),
    list_transform(range(1, len(parts) + 1), lambda i: {'key': 'p:' || host || '/' || array_to_string(parts[1:i], '/'), 'rank': 1000 + i})),
    [{'key': 'u:' || url, 'rank': 1000000}])) as c
  from captures where host <> ''),
hits as (
  select a.url, a.fetched_on, s.key, s.level, s.valid_from,
    row_number() over (partition by a.url, a.fetched_on order by a.c.rank desc, s.key desc) as n
  from asked a join spans s on s.key = a.c.key and s.valid_from <= a.fetched_on
    and (s.valid_to is null or a.fetched_on < s.valid_to))
select c.page_id, c.url, c.fetched_on,
  case h.level when 3 then 'block' when 2 then 'allow' else 'none' end as decision, h.key as rule, h.valid_from as listed_since
from captures c left join hits h on h.url = c.url and h.fetched_on = c.fetched_on and h.n = 1
"""


@query("op1_url_filter", _OP1_SQL)
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures, entries = dated(table(spark, sf_dir, "pages"))
    return urlfilter.decide(captures, entries)


@query("op2_simhash_neardup")
def op2_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    grammar = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, grammar)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(learnable()))
    found = langid.identify(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query("op7_secrets")
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.digest(secrets.scan(docs, secrets.fit(docs)))


@query("op8_sentencepiece")
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


@query("op5_nearest")
def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return forest.nearest(vectors, vectors.where("vec_id % 100 = 0"))


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    # The table's sites: a source is a host, its languages are its paths.
    docs = docs.select("doc_id", "text", F.col("source").alias("host"), F.col("lang").alias("path"))
    found = quality.classify(docs, labels, quality.fit(docs, labels))
    return found.select("doc_id", held_out().alias("held_out"), "own", "site", "score", "keep")


BYTE_BPE = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
)


@query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE)


@query("op10_fingerprints")
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(fingerprints.compared(table(spark, sf_dir, "documents")))
    return fingerprints.with_neighbors(rows, F.col("doc_id") % 100 == 0)


_OP11_SQL = r"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
w as (select r, lang, source, unnest(terms) as term from d),
kept as (select lang, term, count(*) as total from w group by all having count(distinct r) >= 10),
sizes as (select lang, count(*) as v, sum(total) as n from kept group by lang),
cells as (select w.lang, w.source, w.term, count(*) as n from w join kept using (lang, term) group by all),
groups as (
  select g.lang, g.source, coalesce(s.v, 0) as v, coalesce(s.n, 0) as lang_n, coalesce(c.n, 0) as n
  from (select distinct lang, source from d) g left join sizes s on g.lang = s.lang
  left join (select lang, source, sum(n) as n from cells group by all) c on g.lang = c.lang and g.source = c.source),
p as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (g.n + 2 * g.v) as p,
    1 + (1000000000::hugeint * (k.total + 2)) // (g.lang_n + 2 * g.v) as q
  from groups g join kept k on g.lang = k.lang left join cells c on c.lang = g.lang and c.source = g.source and c.term = k.term),
apart as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(x.value, 0) as bigint) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join apart x on x.lang = a.lang and x.source = a.source and x.item = b.source),
terms as (
  select lang, source, 'term' as part, term as item, cast(((p - q) * (p - q)) // (p + q) as bigint) as value
  from p where n > 0 and p > q),
ranked as (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank
  from (select * from pairs union all select * from terms))
select * from ranked where part = 'pair' or rank <= 10
"""


@query("op11_divergence", _OP11_SQL)
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query("op12_bestfit")
def op12_bestfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack(table(spark, sf_dir, "documents"), BYTE_BPE)


@query("op13_variants")
def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(table(spark, sf_dir, "documents"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
