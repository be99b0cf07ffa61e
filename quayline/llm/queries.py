"""The registered queries of the corpus operators, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayline.llm import clusters, decontaminate, hard_negatives, language, mixing, pages, quality, repeats, simhash
from quayline.llm import token_counts, token_files, topk, url_filter
from quayline.llm.common import fold, table, utf8
from quayline.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

VOCABULARY = "byte_bpe_50k.json"
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: The URL list of the registered query: pages of hosts that carry one of these names.
LISTED_HOSTS = ["cheap-pills", "spam-farm", "free-bets", "ads-track"]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    model = quality.train(docs, labels)
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    )


@query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = token_files.write_tokens(docs, vocabulary_path(), scratch_path(spark, "tokens"))
    return token_files.read_tokens(spark, manifest)


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    dictionaries = language.train(docs.where(fold("doc_id", 4) != 2))
    found = language.identify(docs, dictionaries)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op5_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query
def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.find_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")


@query
def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = table(spark, sf_dir, "pages").select("page_id", "url")
    named = "|".join(LISTED_HOSTS)
    listed = urls.where(url_filter.host(F.col("url")).rlike(rf"(^|\.)({named})\."))
    return url_filter.filter_urls(urls, listed, RULES).select("row.page_id", "host", "path", "rule", "verdict")


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary_path())


@query
def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(table(spark, sf_dir, "embeddings")).summary()


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.select("vec_id", "embedding", moved.alias("label")))


def _url_sql() -> str:
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    fits = []
    for action, host, path in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        fits.append((f"(host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{path}')", host + path, action))
    rule = " ".join(f"when {c} then '{r}'" for c, r, _ in fits)
    action = " ".join(f"when rule = '{r}' then '{a}'" for _, r, a in fits)
    tracking = r"(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*"
    return rf"""
with split as (
  select page_id, url,
    coalesce(translate(regexp_extract(url, '{parts}', 1), '{url_filter.UPPER}', '{url_filter.LOWER}'), '') as host,
    coalesce(regexp_extract(url, '{parts}', 2), '') as path,
    coalesce(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '') as query
  from pages),
short as (
  select page_id, host, path,
    regexp_replace(host, '^(www|m)\.', '') as bare,
    regexp_replace(regexp_replace(path, '\.html?$', ''), '/+$', '') as stem,
    regexp_replace(regexp_replace(query, '{tracking}', '', 'gi'), '^&', '') as query,
    case {rule} end as rule
  from split),
keyed as (
  select page_id, host, path, rule,
    case when bare <> '' then bare || stem || case when query <> '' then '?' || query else '' end end as key
  from short),
listed as (
  select distinct key from keyed where key is not null and regexp_matches(host, '(^|\.)({"|".join(LISTED_HOSTS)})\.'))
select page_id, host, path, rule,
  case {action} when key is not null and key in (select key from listed) then 'block' else 'allow' end as verdict
from keyed"""


def _mixing_sql() -> str:
    """The same rounds of raking, unrolled."""
    named = " ".join(f"when lang = '{k}' then {v!r}" for k, v in mixing.LANGUAGE_SHARES.items())
    ctes = [
        r"""rows_ as materialized (
  select doc_id, coalesce(source, '') as source, coalesce(lang, '') as lang,
    case when contains(coalesce(text, ''), ' | ') then 'table' when contains(coalesce(text, ''), 'icense') then 'licensed'
         when contains(coalesce(text, ''), '@') then 'contact' when contains(coalesce(text, ''), chr(10)) then 'article'
         else 'note' end as topic,
    coalesce(len(regexp_extract_all(text, '[^ \t\n\r]+')), 0)::bigint as n_tokens
  from documents)""",
        "c0 as materialized (select source, lang, topic, sum(n_tokens)::double as tokens, 1.0::double as weight from rows_ group by all)",
    ]
    for d in mixing.DIMENSIONS:
        raw = f"pow(now_, {mixing.TEMPER})" if d != "lang" else f"coalesce(case {named} end::double, now_ / (select sum(tokens) from c0))"
        ctes.append(f"raw_{d} as materialized (select {d}, case when now_ > 0 then {raw} else 0.0 end as raw from (select {d}, sum(tokens) as now_ from c0 group by {d}))")
        ctes.append(f"goal_{d} as materialized (select {d}, raw * ((select sum(tokens) from c0) / (select sum(raw) from raw_{d})) as target from raw_{d})")
    step = 0
    for _ in range(mixing.ROUNDS):
        for d in mixing.DIMENSIONS:
            ctes.append(f"h{step} as materialized (select {d}, sum(tokens * weight) as held from c{step} group by {d})")
            ctes.append(
                f"c{step + 1} as materialized (select source, lang, topic, tokens, weight * case when held > 0 then target / held else 1.0 end as weight "
                f"from c{step} join h{step} using ({d}) join goal_{d} using ({d}))"
            )
            step += 1
    return (
        "with " + ",\n".join(ctes) + f""",
p as materialized (select source, lang, topic,
  round(case when tokens > 0 then weight / (select max(weight) from c{step} where tokens > 0) else 1.0 end, 9) as probability from c{step})
select doc_id, source, lang, topic, n_tokens, probability,
  ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 8))::bigint::double / 4294967296.0 < probability as selected
from rows_ join p using (source, lang, topic)"""
    )


def _clusters_sql() -> str:
    """The same rounds of assignment and update, unrolled, over one row per vector and component."""
    ctes = [
        f"""kept as materialized (select row_number() over () as r, vec_id, [floor({clusters.SCALE} * x::double)::bigint for x in embedding] as v
  from embeddings where len(embedding) = {clusters.WIDTH} and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
x as materialized (select r, unnest(range(1, {clusters.WIDTH} + 1)) as i, unnest(v) as x from kept),
c0 as materialized (select (row_number() over (order by key, v) - 1)::int as c, unnest(range(1, {clusters.WIDTH} + 1)) as i, unnest(v) as m
  from (select v, sha256('{clusters.SEED}:' || vec_id) as key from kept order by key, v limit {clusters.K}))"""
    ]
    for n in range(clusters.ROUNDS + 1):
        ctes.append(
            f"""d{n} as materialized (select r, c, sum((x - m) * (x - m))::bigint as d from x join c{n} using (i) group by r, c),
a{n} as materialized (select r, min_by(c, (d, c)) as c, min(d) as d from d{n} group by r)"""
        )
        if n < clusters.ROUNDS:
            ctes.append(
                f"""s{n} as materialized (select c, i, sum(x)::bigint as s, count(*) as n from x join a{n} using (r) group by c, i),
c{n + 1} as materialized (select c, i, coalesce((s - ((s % n) + n) % n) // n, m)::bigint as m from c{n} left join s{n} using (c, i))"""
            )
    last = clusters.ROUNDS
    return (
        "with " + ",\n".join(ctes) + f""",
h as (select c, sha256(string_agg(m::varchar, ',' order by i)) as h from c{last} group by c),
t as (select c, sum(d)::bigint as t from a{last} group by c)
select vec_id, c as cluster, d as distance, t as cluster_inertia, (select sum(t) from t)::bigint as inertia, h as centroid_sha256
from a{last} join kept using (r) join h using (c) join t using (c)"""
    )


def _hard_negatives_sql() -> str:
    """Every anchor against all rows."""
    scale, every = hard_negatives.SCALE, hard_negatives.EVERY
    return f"""
with x as materialized (
  select vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label,
    [floor({scale} * x::double) for x in embedding] as v
  from embeddings where vec_id is not null and label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as materialized (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
  from x a, x b where a.vec_id % {every} = 0 and a.vec_id <> b.vec_id),
p as materialized (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {hard_negatives.POSITIVES})
select anchor_id, positive_id, (row_number() over w)::int as rank, vec_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and {hard_negatives.LOW} * positive_score <= 100 * score and 100 * score <= {hard_negatives.HIGH} * positive_score
window w as (partition by anchor_id, positive_id order by score desc, vec_id)
qualify row_number() over w <= {hard_negatives.NEGATIVES}"""


ORACLE_SQL["op9_url_filter"] = _url_sql()
ORACLE_SQL["op12_clusters"] = _clusters_sql()
ORACLE_SQL["op13_hard_negatives"] = _hard_negatives_sql()
ORACLE_SQL["op3_mixing"] = _mixing_sql()
