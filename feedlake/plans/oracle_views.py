"""DuckDB forms of the fixture views, inlined as CTEs into oracle queries."""

from __future__ import annotations

VIEWS: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def view(name: str, sql: str, deps: list[str] | None = None) -> None:
    VIEWS[name] = sql.strip()
    DEPS[name] = deps or []


view("v_entries", """
select p.page_id as entry_id,
       regexp_extract(p.url, '^https?://([^/?#]+)', 1) as source,
       p.url as link,
       regexp_extract(p.html, '<title>([^<]*)</title>', 1) as title,
       p.html as summary,
       e.ts as published_at,
       case p.page_id % 5 when 0 then 'security' when 1 then 'backend' when 2 then 'frontend'
            when 3 then 'devops' else 'general' end as source_category
from pages p join events e on e.event_id = p.page_id
""")

view("v_verdicts_raw", """
select event_id as entry_id, event_type as source,
       concat('https://', event_type, '.example.com/', cast(user_id as varchar), '/', json_extract_string(props, '$.k')) as link,
       concat(event_type, ' ', cast(event_id as varchar)) as title,
       ts as published_at,
       case event_type when 'error' then 'security' when 'purchase' then 'backend' when 'click' then 'frontend'
            when 'view' then 'devops' else 'general' end as source_category,
       case event_type when 'error' then 'critical' when 'purchase' then 'important' when 'click' then 'notable'
            when 'view' then 'ignore' else 'urgent' end as raw_severity,
       value as raw_score, (event_id % 2 = 0) as kept,
       case user_id % 7 when 0 then 'security' when 1 then 'backend' when 2 then 'frontend' when 3 then 'devops'
            when 4 then 'ai' when 5 then 'general' else 'cloud' end as raw_category
from events
""")

view("v_verdicts", """
select entry_id, source, link, title, published_at, source_category, kept,
       sha256(link) as hash,
       case when raw_severity in ('critical','important','notable','ignore') then raw_severity else 'ignore' end as severity,
       case when raw_category in ('security','backend','frontend','devops','ai','general') then raw_category else 'general' end as category,
       greatest(1, least(10, cast(trunc(raw_score) as int))) as score
from v_verdicts_raw
""", ["v_verdicts_raw"])

view("v_ledger", """
select hash, min(link) as url, min(published_at) as seen_at
from v_verdicts where published_at < timestamp '2024-01-15 00:00:00' group by hash
""", ["v_verdicts"])

view("v_runs", """
select distinct cast(cast(published_at as date) as timestamp) + interval 27 hours as run_ts from v_verdicts
""", ["v_verdicts"])

view("v_sources", """
select distinct regexp_extract(url, '^https?://([^/?#]+)', 1) as source,
       concat(regexp_extract(url, '^(https?://[^/?#]+)', 1), '/feed') as url,
       case length(regexp_extract(url, '^https?://([^/?#]+)', 1)) % 5 when 0 then 'security' when 1 then 'backend'
            when 2 then 'frontend' when 3 then 'devops' else 'general' end as category
from pages
""")

view("v_daily", """
select *, cast(cast(published_at as date) as timestamp) + interval 27 hours as run_ts,
       entry_id as response_pos,
       case severity when 'critical' then 0 when 'important' then 1 when 'notable' then 2 else 3 end as severity_rank
from v_verdicts
""", ["v_verdicts"])


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs it needs, dependencies first."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} as (\n{VIEWS[n]}\n)" for n in order)
    body = sql.strip()
    if body.lower().startswith("with recursive "):
        return f"with recursive {ctes},\n{body[15:]}"
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
