"""Queries that apply the operators to their whole tables, with the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketgrain.llm import (
    byte_bpe, decontamination, exact_dedup, licenses, merkle, near_dedup, prefix_trie, quality, secret_scan, sharding,
    token_counts, toxicity, url_filters,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op3_exact_dedup", sql=r"""
with texts as (
    select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body from documents)
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
    doc_id = min(doc_id) over same as kept, sha256(body) as text_sha256
from texts window same as (partition by body)
""")
def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.groups(table(spark, folder, "documents"))


@query("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, folder, "documents"))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query("op5_decontamination", sql=f"""
with doc_words as (select doc_id, {_WORDS} as words from documents),
item_words as (select item_id, {_WORDS} as words from benchmark),
item_starts as (
    select item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as s from item_words where len(words) > 0),
windows as (
    select distinct item_id, words[s:s + 9] as w, len(words[s:s + 9]) as n from item_starts),
lengths as (select distinct n from windows),
doc_starts as (
    select doc_id, words, n, unnest(range(1, len(words) - n + 2)) as s from doc_words, lengths where len(words) >= n),
found as (
    select d.doc_id, d.s, w.n, w.item_id from doc_starts d join windows w on w.n = d.n and w.w = d.words[d.s:d.s + d.n - 1]),
hit as (
    select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + n)) as p from found) group by 1),
items as (
    select doc_id, count(*) as n_items, string_agg(i, ',' order by i) as ids
    from (select distinct doc_id, cast(item_id as varchar) as i from found) group by 1)
select d.doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from doc_words d left join hit using (doc_id) left join items using (doc_id)
""")
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op6_near_dedup", sql="""
with recursive words as (
    select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
    from documents),
shingles as (
    select distinct doc_id, w[s:s + 2] as g
    from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) as s from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by 1),
shared as (
    select a.doc_id as a, b.doc_id as b, count(*) as k from shingles a join shingles b on a.g = b.g and a.doc_id <> b.doc_id
    group by all),
links as (
    select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * k >= 85 * (x.n + y.n - k)),
reached(d, r) as (select doc_id, doc_id from documents union select d, b from reached join links on r = a),
heads as (select d, min(r) as component_id from reached group by d)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
from documents left join sizes using (doc_id) join heads on d = doc_id
""")
def op6_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_components(table(spark, folder, "documents"))


_RULES = ", ".join(
    f"('{r.text}', '{r.host}', '{r.path}', '{r.verdict}')" for r in url_filters.RULES
)


@query("op7_url_filters", sql=rf"""
with recursive rules(rule, rule_host, rule_path, verdict) as (values {_RULES}),
pages_split as (
    select page_id, url, html,
        translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path
    from pages),
targets as (
    select url as a, unnest([
        regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'),
                       '(?is)\bhref\s*=\s*["'']?\s*([^"''>\s]+)', 1),
        regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'),
                       '(?is)\burl\s*=\s*["'']?\s*([^"''>\s;]+)', 1)]) as target
    from pages where url like '%://%'),
links as (
    select a, case when regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') then target
                   when target like '//%' then regexp_extract(a, '^(.*?)://', 1) || ':' || target
                   when target like '/%' then regexp_extract(a, '^.*?://[^/?#]*') || target end as b
    from targets where target <> ''),
edges as (select a, b from links where a <> b union select b, a from links where a <> b),
nodes as (
    select distinct a as node,
        translate(regexp_extract(a, '^(?s:.*?)://([^/?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(a, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path
    from edges),
reached(node, other) as (
    select node, node from nodes union select r.node, e.b from reached r join edges e on e.a = r.other),
node_rules as (
    select n.node, arg_max(verdict, length(rule)) as verdict from nodes n join rules
        on (n.host = rule_host or ends_with(n.host, '.' || rule_host)) and starts_with(n.path, rule_path)
    group by n.node),
component_blocked as (
    select r.node from reached r join node_rules v on v.node = r.other and v.verdict = 'block' group by r.node),
own as (
    select page_id, url, host, path, rule, rules.verdict,
        row_number() over (partition by page_id, url order by length(rule) desc) as n
    from pages_split left join rules
        on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)),
heads as (select min(other) as component, node from reached group by node)
select page_id, host, path, rule,
    coalesce(verdict, case when b.node is not null then 'block' else 'allow' end) as verdict, component
from own left join component_blocked b on b.node = own.url left join heads h on h.node = own.url
where n = 1
""")
def op7_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.judge(table(spark, folder, "pages"))


@query("op8_quality")
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


_NOTICES = ", ".join(
    f"('{name}', '{shingle}', {len(set(found))})"
    for name, text in sorted(licenses.TEMPLATES.items()) for found in [licenses.plain_shingles(text)] for shingle in sorted(set(found))
)

_SHORT_RUNS = ", ".join(f"('{name}', {licenses.short_words(text)})" for name, text in sorted(licenses.SHORT.items()))


@query("op9_license_scan", sql=rf"""
with templates(license, shingle, n) as (values {_NOTICES}),
words as (
    select doc_id, list_transform(regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}.\-]*'),
        lambda x: rtrim(x, '.-')) as w from documents),
places as (
    select doc_id, w, unnest(range(0, greatest(len(w) - 4, 1))) as p from words where len(w) > 0),
short_templates(license, run) as (values {_SHORT_RUNS}),
runs as (select doc_id, w, unnest(range(0, len(w))) as p from words),
shingles as (select doc_id, p, array_to_string(w[p + 1:p + 5], ' ') as shingle from places),
held as (select doc_id, license, n, p, s.shingle from shingles s join templates t on s.shingle = t.shingle),
windows as (
    select doc_id, license, n, shingle, p // n * n as win from held
    union all select doc_id, license, n, shingle, p // n * n - n from held where p >= n),
verified as (
    select doc_id, license, win, count(distinct shingle) / n as containment from windows group by doc_id, license, n, win
    having count(distinct shingle) * 100 >= 80 * n
    union all
    select doc_id, license, p, 1.0::double from runs join short_templates on w[p + 1:p + len(run)] = run)
select doc_id, license, count(*) as n_windows, min(win) as first_window, max(containment) as containment
from verified group by doc_id, license
""".replace("\\\\", "\\"))
def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@query("op10_sharding")
def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.interleave(table(spark, folder, "documents"), shards=40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _spans_sql(rule: secret_scan.Rule, rank: int) -> str:
    """Spans of one rule: the pieces between the matches and the matches add up to the places."""
    pattern = rule.pattern.replace("'", "''")
    return f"""
    select doc_id, '{rule.kind}' as kind, {rank} as rank, {str(rule.base).lower()} as base,
        list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(whole[1:i - 1],
            lambda m: length(m))), 0) as start, length(whole[i]) as size
    from (select *, unnest(range(1, len(whole) + 1)) as i from (
        select doc_id, string_split_regex(body, '{pattern}') as gaps, regexp_extract_all(body, '{pattern}') as whole,
            regexp_extract_all(body, '{pattern}', {rule.group}) as part from texts))
    where length(part[i]) >= {max(rule.least, 1)}"""


@query("op11_secret_scan", sql=f"""
with texts as (select doc_id, coalesce(text, '') as body from documents),
spans as ({" union all ".join(_spans_sql(rule, rank) for rank, rule in enumerate(secret_scan.RULES))}),
named as (select *, kind || ':' || cast(start as bigint) || ':' || cast(start + size as bigint) as name from spans),
found as (
    select doc_id, string_agg(name, ',' order by start, rank) filter (where base) as base_spans,
        string_agg(name, ',' order by start, rank) as spans, count(*) filter (where kind = 'assign') as n_assign,
        count(*) filter (where kind = 'access') as n_access, count(*) filter (where kind = 'hex') as n_hex
    from named group by doc_id)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
    sha256(coalesce(base_spans, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join found using (doc_id)
""")
def op11_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.report(table(spark, folder, "documents"))


def _crc_sql(number: str) -> str:
    """Unsigned CRC-32 of a number's decimal digits, bit by bit."""
    digits = f"list_transform(string_split(cast({number} as varchar), ''), lambda x: cast(ascii(x) as bigint))"
    return f"""xor(list_reduce(list_prepend(4294967295::bigint, {digits}), lambda c, b: list_reduce(
        list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""


def _leaf_sql(number: str) -> str:
    values = [f"cast({c} as varchar)" for c in ("doc_id", "source", "lang", number, "text")]
    return "sha256(" + " || ".join(f"case when {v} is null then '-' else strlen({v}) || ':' || {v} end" for v in values) + ")"


def _climb_sql(rows: str, key: str) -> str:
    """Nodes of all levels: key, level, place, digest, and the number of nodes on the level."""
    return f"""
    select {key} as key, 0 as level, place, hash, n from {rows}
    union all
    select key, level + 1, place // 2, sha256(string_agg(hash, '' order by place)), (n + 1) // 2
    from REACHED where n > 1 group by key, level, place // 2, n"""


def _steps_sql(rows: str, key: str, nodes: str, phase: int) -> str:
    """A step for each level below the top: the sibling with its side, or none."""
    return f"""
    select r.doc_place, {phase} as phase, l.level,
        case when s.hash is null then 'N' when s.place < (r.place >> l.level) then 'L' || s.hash else 'R' || s.hash end as step
    from {rows} r join (select distinct key, level from {nodes} where n > 1) l on l.key is not distinct from r.{key}
        left join {nodes} s on s.key is not distinct from r.{key} and s.level = l.level
            and s.place = xor(r.place >> l.level, 1)"""


_FOLD = """list_reduce(list_prepend({start}, steps), lambda h, s: sha256(
    case when s[1] = 'L' then s[2:] || h when s[1] = 'R' then h || s[2:] else h end))"""


@query("op12_merkle_manifest", sql=f"""
with recursive leaves as (
    select doc_id, lang, hash, changed, row_number() over (partition by lang order by doc_id nulls first, hash) - 1 as place,
        row_number() over () as doc_place, count(*) over (partition by lang) as n
    from (select doc_id, lang, {_leaf_sql("n_chars")} as hash,
        case when {_crc_sql("doc_id")} % 7 = 0 then {_leaf_sql("n_chars + 1")} end as changed from documents)),
nodes(key, level, place, hash, n) as ({_climb_sql("leaves", "lang").replace("REACHED", "nodes")}),
tops as (
    select key as lang, hash, 0 as whole, row_number() over (order by key nulls first) - 1 as place, count(*) over () as n
    from nodes where n = 1),
top_nodes(key, level, place, hash, n) as ({_climb_sql("tops", "whole").replace("REACHED", "top_nodes")}),
leaves_of_tops as (select l.doc_place, t.whole, t.place from leaves l join tops t on t.lang is not distinct from l.lang),
steps as (
    select doc_place, list(step order by phase, level) as steps from (
        {_steps_sql("leaves", "lang", "nodes", 0)} union all {_steps_sql("leaves_of_tops", "whole", "top_nodes", 1)})
    group by doc_place),
rows as (
    select l.doc_id, l.hash as leaf, t.hash as subroot, (select hash from top_nodes where n = 1) as root, l.changed,
        coalesce(s.steps, []) as steps
    from leaves l join tops t on t.lang is not distinct from l.lang left join steps s using (doc_place)),
folded as (select *, {_FOLD.format(start="coalesce(changed, leaf)")} as folded_root from rows)
select doc_id, leaf, subroot, root,
    sha256(array_to_string(list_transform(list_filter(steps, lambda s: s <> 'N'), lambda s: s[2:]), '')) as proof_sha256,
    folded_root, folded_root = root as verified
from folded
""")
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.verify(table(spark, folder, "documents"))


@query("op13_prefix_trie", sql=rf"""
with turns as (
    select conv_id, row_number() over (partition by conv_id order by turn nulls first, id) as k, id, words
    from (select conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as id,
            len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as words
        from conversations where conv_id is not null)),
convs as (select conv_id, {_crc_sql("conv_id")} % 4 as h from (select distinct conv_id from turns)),
parts as (
    select c.conv_id, 0 as part, t.k, t.id, t.words from convs c join turns t on t.conv_id = c.conv_id - c.conv_id % 20
        and t.k <= c.h
    union all
    select c.conv_id, 1, t.k, t.id, t.words from convs c join turns t on t.conv_id = c.conv_id and t.k > c.h),
whole as (
    select conv_id, list(id order by part, k) as ids, list(words order by part, k) as words from parts group by conv_id),
rebuilt as (
    select conv_id, coalesce(ids, []) as ids, coalesce(words, []) as words from convs left join whole using (conv_id)),
prefixes as (
    select conv_id, d, ids[1:d] as name, case when d = 0 then 0 else words[d] end as words, len(ids) = d as ends
    from (select *, unnest(range(0, len(ids) + 1)) as d from rebuilt)),
nodes as (
    select d, name, min(conv_id) as conv_id, count(*) as n_convs, any_value(words) as words,
        string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where ends) as ended
    from prefixes group by d, name),
kids as (select d - 1 as d, name[1:d - 1] as name, count(*) as n_children from nodes where d > 0 group by all),
counted as (select n.*, coalesce(k.n_children, 0) as n_children from nodes n left join kids k using (d, name)),
under as (
    select a as d, name[1:a] as name, sum(case when n_children = 0 then 1 else 0 end) as n_leaves,
        sum((n_convs - 1) * words) as saved
    from (select *, unnest(range(0, d + 1)) as a from counted) group by all)
select c.conv_id, cast(c.d as bigint) as depth, p.conv_id as parent_conv_id, c.n_convs, c.n_children,
    cast(u.n_leaves as bigint) as n_leaves, cast(u.saved as bigint) as saved_tokens,
    sha256(coalesce(c.ended, '')) as ends_sha256
from counted c join under u on u.d = c.d and u.name = c.name
    left join nodes p on p.d = c.d - 1 and p.name = c.name[1:c.d - 1]
""")
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))
