"""DuckDB SQL for the queries it can express."""

from parley.llm import centroids, ranked_search, urls


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _address(url: str) -> str:
    rest = f"substr({url}, instr({url}, '://') + 3)"
    part = lambda i: f"regexp_extract({rest}, {_text(urls.HOST_PATH)}, {i})"
    host = f"translate({part(1)}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    path = f"case when {part(2)} = '' then '/' else {part(2)} end"
    query = f"case when {part(3)} = '?' then '' else {part(3)} end"
    return f"case when instr({url}, '://') > 0 then {host} || {path} || {query} end"


def _host(url: str) -> str:
    part = f"regexp_extract(substr({url}, instr({url}, '://') + 3), {_text(urls.HOST_PATH)}, 1)"
    low = f"translate({part}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"case when instr({url}, '://') > 0 then {low} else '' end"


def _path(url: str) -> str:
    part = f"regexp_extract(substr({url}, instr({url}, '://') + 3), {_text(urls.HOST_PATH)}, 2)"
    return f"case when instr({url}, '://') > 0 then {part} else '' end"


def _best(of: str, host: str, path: str) -> str:
    """The rule that decides; ``of`` picks its action or its text."""
    cases = []
    for action, rule in sorted(set(urls.RULES), key=lambda r: (-len(r[1]), r[1], r[0])):
        own, slash, rest = rule.partition("/")
        fits = f"({host} = '{own}' or ends_with({host}, '.{own}')) and starts_with({path}, '{slash}{rest}')"
        cases.append(f"when {fits} then '{action if of == 'action' else rule}'")
    return f"case {' '.join(cases)} end"


_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _clusters() -> str:
    """Every round of the clustering as a table of its own."""
    squared = "list_sum(list_transform(range(1, {d} + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i])))".format(d=centroids.DIMENSIONS)
    parts = [
        f"""e as (select vec_id, list_transform(embedding, lambda x: x::double) e from embeddings
    where len(embedding) = {centroids.DIMENSIONS}
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"""v as materialized (select row_number() over () r, vec_id,
    list_transform(e, lambda x: floor({centroids.SCALE} * x)::bigint) v from e
    where len(list_filter(e, lambda x: abs(x) > {centroids.LARGEST // centroids.SCALE})) = 0)""",
        f"""c0 as materialized (select row_number() over (order by vec_id is null, sha256('{centroids.SEED}:' || vec_id), v) - 1 k, v c
    from v qualify k < {centroids.CLUSTERS})""",
    ]
    for i in range(centroids.ROUNDS + 1):
        parts.append(
            f"""a{i} as materialized (select r, arg_min(k, (d, k)) k, min(d) d
    from (select r, k, {squared} d from v, c{i}) group by r)"""
        )
        if i < centroids.ROUNDS:
            parts.append(
                f"""s{i} as (select k, j, sum(v[j])::bigint s, count(*) n from a{i} join v using (r), range(1, {centroids.DIMENSIONS} + 1) t(j)
    group by k, j)"""
            )
            parts.append(
                f"""c{i + 1} as materialized (select k, coalesce(m, c) c from c{i} left join
    (select k, list((s - ((s % n) + n) % n) // n order by j) m from s{i} group by k) using (k))"""
            )
    end = centroids.ROUNDS
    return f"""with {", ".join(parts)}
select vec_id, k::int as cluster, d::bigint as distance, sum(d) over (partition by k)::bigint as cluster_inertia,
    sum(d) over ()::bigint as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
from a{end} join v using (r) join c{end} using (k)"""


ORACLE = {
    "op1_embedding_dedup": """
with recursive v as (
    select vec_id, label, list_transform(embedding, lambda x: x::double) e from embeddings
), ok as (
    select vec_id, label, e, sqrt(list_dot_product(e, e)) as norm from v
    where label is not null and len(e) > 0
      and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(e, lambda x: x <> 0)) > 0
), links as (
    select a.vec_id a, b.vec_id b from ok a join ok b on a.label = b.label and a.vec_id <> b.vec_id
    and len(a.e) = len(b.e)
    where list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), reach(a, b) as (
    select vec_id, vec_id from embeddings
    union
    select r.a, l.b from reach r join links l on r.b = l.a
), component as (select a, min(b) c from reach group by a)
select e.vec_id, coalesce(n, 0)::bigint as n_links, c as component_id, e.vec_id = c as kept
from embeddings e join component on component.a = e.vec_id
left join (select a, count(*) n from links group by a) x on x.a = e.vec_id
""",
    "op6_url_filter": f"""
with recursive tags as (
    select url, unnest(regexp_extract_all(html, {_text(urls.TAG)})) tag from pages
    where url is not null and regexp_matches(html, {_text(urls.HAS_LINK)})
), named as (
    select url, replace(trim(case
        when regexp_matches(tag, {_text(urls.CANONICAL)}) then regexp_extract(tag, {_text(urls.HREF)}, 1)
            || regexp_extract(tag, {_text(urls.HREF)}, 2) || regexp_extract(tag, {_text(urls.HREF)}, 3)
        when regexp_matches(tag, {_text(urls.REFRESH)}) then regexp_extract(tag, {_text(urls.REFRESH_URL)}, 1)
        end), '&amp;', '&') target, 'x://' || {_host("url")} base, {_path("url")} path
    from tags
), resolved as (
    select url, case
        when regexp_matches(target, {_text(urls.ABSOLUTE)}) then target
        when starts_with(target, '//') then 'x:' || target
        when starts_with(target, '/') then base || target
        when starts_with(target, '?') then base || path || target
        when starts_with(target, '#') or regexp_matches(target, {_text(urls.SCHEME)}) then null
        else base || regexp_replace(case when path = '' then '/' else path end, '[^/]*$', '') || target end as target
    from named where target <> ''
), links as (
    select {_address("url")} a, {_address("target")} b from resolved
), both_ways as (
    select a, b from links where a <> b union select b, a from links where a <> b
), reach(a, b) as (
    select a, a from both_ways union select r.a, l.b from reach r join both_ways l on r.b = l.a
), component as (
    select a, min(b) c from reach group by a
), judged as (
    select a, c, {_best("action", _host("'x://' || a"), _path("'x://' || a"))} as verdict from component
), blocked as (
    select c from judged group by c having bool_or(coalesce(verdict = 'block', false)) and not bool_or(coalesce(verdict = 'allow', false))
), parsed as (
    select page_id, coalesce({_host("url")}, '') host, coalesce({_path("url")}, '') path, {_address("url")} address from pages
)
select page_id, host, path, {_best("rule", "host", "path")} as rule,
    coalesce({_best("action", "host", "path")}, case when b.c is not null then 'block' else 'allow' end) as verdict
from parsed left join component k on k.a = address left join blocked b on b.c = k.c
""",
    "op11_exact_dedup": f"""
with t as (select doc_id, {_LOW.format("coalesce(text, '')")} body from documents)
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
    row_number() over (partition by body order by doc_id desc nulls last) = 1 as kept, sha256(body) as text_sha256
from t window g as (partition by body)
""",
    "op12_ranked_search": f"""
with d as (
    select row_number() over () r, doc_id, {_LOW.format("text")} t from documents
), occurrences as (
    select r, unnest(regexp_extract_all(t, '{_TERM}')) term from d
), lengths as (select r, count(*) n from occurrences group by r),
totals as (select count(*) as docs, sum(n)::bigint as total from lengths),
asked as (
    select distinct i, item_id, unnest(regexp_extract_all({_LOW.format("text")}, '{_TERM}')) term
    from (select row_number() over () i, * from benchmark)
), tf as (
    select r, term, count(*) tf from occurrences where term in (select term from asked) group by r, term
), weights as (
    select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint w
    from tf, totals group by term, docs
), parts as (
    select r, term, (1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)) part
    from tf join lengths using (r), totals
), scored as (
    select i, item_id, r, sum(w * part)::bigint score from asked join weights using (term) join parts using (term)
    group by i, item_id, r
)
select item_id, row_number() over (partition by i order by score desc, doc_id nulls last)::int as rank, doc_id, score
from scored join d using (r) where score > 0 qualify rank <= {ranked_search.TOP}
""",
    "op13_centroid_clusters": _clusters(),
}
