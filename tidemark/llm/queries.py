"""Registered queries of the corpus operators, with checking SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import contamination, conversations, extraction, language, neighbours, packing, secrets, simhash, substrings, suffixes, toxicity, urls, whitening
from .batches import crc_rest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_paths() -> tuple[str, str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


#: Words of a text as the operators take them: lower-cased A-Z, cut at ASCII white space.
_WORDS = (
    r"list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
)


@query(
    "op1_substrings",
    r"""
with d as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
windows as (select doc_id, i, array_to_string(w[i : i + 19], ' ') as s from d, unnest(range(1, len(w) - 18)) t(i)),
repeats as (select doc_id, i from (select doc_id, i, row_number() over (partition by s order by doc_id, i) as k from windows) where k > 1),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as i from repeats),
kept as (from (select doc_id, i, w[i] as word from d, unnest(range(1, len(w) + 1)) t(i)) anti join gone using (doc_id, i)),
texts as (select doc_id, count(*) as n, string_agg(word, ' ' order by i) as text from kept group by doc_id)
select doc_id, len(w)::bigint as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(t.text, '')) as kept_sha256
from d left join texts t using (doc_id)
""",
)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove(table(spark, folder, "documents")).drop("kept")


@query("op5_suffixes")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove(table(spark, folder, "documents")).drop("kept")


@query(
    "op2_decontaminate",
    f"""
with d as (select doc_id, {_WORDS} as w from documents where doc_id is not null and text is not null),
b as (select item_id, {_WORDS} as w from benchmark where item_id is not null and text is not null),
ds as (select distinct doc_id, array_to_string(w[i : i + 4], ' ') as s from d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i) where len(w) > 0),
bs as (select distinct item_id, array_to_string(w[i : i + 4], ' ') as s from b, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i) where len(w) > 0),
n as (select item_id, count(*) as n_shingles from bs group by item_id),
m as (select doc_id, item_id, count(*) as n_shared from ds join bs using (s) group by all)
select doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles as containment
from m join n using (item_id) where n_shared >= 0.8 * n_shingles - 1e-9
""",
)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op3_language")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(crc_rest("doc_id", 3) == 1, F.lit(False))
    model = language.fit(docs.where(~held_out))
    return language.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op4_simhash")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op6_toxicity")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc_rest("doc_id", 5) == 0, F.lit(False))
    lexicon = toxicity.fit(docs.where(~held_out), table(spark, folder, "labels"))
    return toxicity.score(docs, lexicon).select("doc_id", held_out.alias("held_out"), "score", "predicted")


#: On the given pages: what stands in the article element, cut at its headings and paragraphs.
@query(
    "op7_extraction",
    r"""
with a as (select page_id, url, string_split_regex(replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '<br>', ' '), '</?(?:p|h1)>') as parts from pages),
plain as (select page_id, url, list_transform(parts, lambda x: replace(replace(replace(replace(replace(
    regexp_replace(x, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&')) as parts from a),
lines as (select page_id, url, array_to_string(list_filter(list_transform(parts, lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) as text from plain)
select page_id, url, text, length(text) as n_chars from lines
""",
)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.extract(table(spark, folder, "pages"))


@query("op8_packing")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_paths())


@query("op9_secrets")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return secrets.scan(docs, secrets.fit(docs))


@query("op10_neighbours")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(table(spark, folder, "embeddings"))


#: The site rules asked for: text and verdict.
SITE_RULES = (
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"),
)


#: The pattern rules again, as one expression over host and all that follows.
_BLOCKED = (
    r"(?i)^([^/?#]*\.)?(ads-track|casino-win|cheap-pills|free-bets|spam-farm|adult-x|adserver|doubleclick|malware|phishing)\."
    r"|/adserver/|/doorway/.*\.html$|(^|[^A-Za-z0-9_.%-])click-farm([^A-Za-z0-9_.%-]|$)"
)


@query(
    "op11_urls",
    rf"""
with a as (select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
b as (select page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, coalesce(rest, '') as rest from a),
p as (select page_id, host, regexp_extract(substr(rest, length(host) + 1), '^[^?#]*', 0) as path, host || substr(rest, length(host) + 1) as address from b),
rules(rule_host, rule_path, v) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits as (select page_id, host, path, rule_host || rule_path as rule, v, row_number() over (partition by page_id order by length(rule_host || rule_path) desc) as k
         from p join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select p.page_id, p.host, p.path, f.rule, coalesce(f.v, case when regexp_matches(address, '{_BLOCKED}') then 'block' else 'allow' end) as verdict
from p left join fits f on f.page_id = p.page_id and f.k = 1
""",
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    rules = urls.rules_table(spark, SITE_RULES, [(p, "block") for p in urls.BLOCK_PATTERNS])
    return urls.judge(table(spark, folder, "pages"), rules).drop("pattern")


@query("op12_whitening")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = table(spark, folder, "embeddings")
    return whitening.whiten(embeddings, whitening.fit(embeddings))


#: Byte by byte and bit by bit: crc32 of a number written as text.
_CRC = (
    "list_reduce(list_concat([4294967295], flatten(list_transform(string_split(conv_id::varchar, ''), lambda c: list_concat([ascii(c)::bigint], [-1, -1, -1, -1, -1, -1, -1, -1])))), "
    "lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, case when a & 1 = 1 then 3988292384 else 0 end) end)"
)


@query(
    "op13_conversations",
    f"""
with t as (select conv_id, row_number() over (partition by conv_id order by turn nulls first) as pos, coalesce(role, '') as role, coalesce(text, '') as text
           from conversations where conv_id is not null),
c as (select conv_id, length, (4294967295 - {_CRC}) % 9 as h from (select conv_id, count(*) as length from t group by 1)),
s as (select c.*, least(c.h, coalesce(b.length, 0)) as hb from c left join c b on b.conv_id = c.conv_id - c.conv_id % 5),
r as (select s.conv_id, pos as d, role, text from s join t on t.conv_id = s.conv_id - s.conv_id % 5 and pos <= hb
      union all select s.conv_id, pos - h + hb, role, text from s join t using (conv_id) where pos > h),
p as materialized (select conv_id, d, md5(list(struct_pack(role, text)) over (partition by conv_id order by d)::varchar) as k, strlen(text) as bytes from r
      union all select conv_id, 0, 'root', 0 from s),
q as materialized (select *, lag(k) over (partition by conv_id order by d) as up, d = max(d) over (partition by conv_id) as ends from p),
n as materialized (select k, d, min(conv_id) as conv_id, count(*) as n_convs, count(*) filter (ends) as n_ends, any_value(up) as up, (count(*) - 1) * max(bytes) as saved,
             sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256 from q group by k, d),
below as (select q.k, count(*) filter (n.n_ends = n.n_convs) as n_leaves, sum(n.saved)::bigint as saved_tokens
          from n join q on q.conv_id = n.conv_id and q.d <= n.d group by q.k),
kids as (select up as k, count(*) as n_children from n where d > 0 group by 1)
select n.conv_id, n.d as depth, m.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children, n_leaves, saved_tokens, n.ends_sha256
from n join below using (k) left join kids using (k) left join n m on m.k = n.up
""",
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.trie(table(spark, folder, "conversations"))
