"""The corpus queries by name; ``ORACLES`` has SQL for those that SQL can express."""

from __future__ import annotations

from tidemark.llm import divergence, negatives, topk
from tidemark.llm.contamination import op6_decontamination
from tidemark.llm.jaccard import op1_ngram_jaccard
from tidemark.llm.katz import op9_katz_score
from tidemark.llm.language import op3_language_id, op3_page_language
from tidemark.llm.packing import op7_packing
from tidemark.llm.quality import op2_quality_rules
from tidemark.llm.secret_scan import op10_secret_scan
from tidemark.llm.substring import op5_substring_dedup
from tidemark.llm.token_store import op4_token_store
from tidemark.llm.url_filter import LINKS, op8_url_filter

QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_quality_rules": op2_quality_rules,
    "op3_language_id": op3_language_id,
    "op3_page_language": op3_page_language,
    "op4_token_store": op4_token_store,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_packing": op7_packing,
    "op8_url_filter": op8_url_filter,
    "op9_katz_score": op9_katz_score,
    "op10_secret_scan": op10_secret_scan,
    "op11_source_divergence": divergence.op11_source_divergence,
    "op12_topk_search": topk.op12_topk_search,
    "op13_hard_negatives": negatives.op13_hard_negatives,
}

# The URL rules in SQL, with links and their components.
_HOST = "translate(regexp_extract({0}, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract({0}, '^[^/?#]*([^?#]*)', 1)"
_AFTER = "case when contains({0}, '://') then substr({0}, instr({0}, '://') + 3) end"
_FITS = "(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')"
_CASES = [("example.com", "/en/7", "allow"), ("example.net", "/de/8", "block"), ("com", "/en/", "block"), ("net", "/de/", "allow"), ("org", "/es/", "block")]
_RULE = " ".join(f"when {_FITS.format(h=h, p=p)} then '{h}{p}'" for h, p, _ in _CASES)
_ACTION = " ".join(f"when {_FITS.format(h=h, p=p)} then '{a}'" for h, p, a in _CASES)
_NODE = "case when host <> '' then host || regexp_replace(path, '/+$', '') end"


def _targets(tag: str, has: str, value: str) -> str:
    return f"""select node, host, path, regexp_extract(t, '\\b{value}', 1, 'is') as target from (select node, host, path,
 unnest(list_filter(regexp_extract_all(html, '<{tag}\\b[^<>]*>', 0, 'is'), lambda t: regexp_matches(t, '\\b{has}', 'is'))) as t from c where url is not null)"""


#: The same expressions without possessive marks, which DuckDB neither knows nor needs.
_LINKS = " union all ".join(_targets(*(x.replace("*+", "*").replace("'", "''") for x in link)) for link in LINKS)

ORACLES: dict[str, str] = {
    "op8_url_filter": f"""with recursive a as (select page_id, url, html, {_AFTER.format("url")} as rest from pages),
 b as (select page_id, url, html, coalesce({_HOST.format("rest")}, '') as host, coalesce({_PATH.format("rest")}, '') as path from a),
 c as (select *, case {_RULE} end as rule, case {_ACTION} end as action, {_NODE} as node from b),
 t as ({_LINKS}),
 u as (select node as x, case when contains(target, '://') then target when starts_with(target, '//') then 'x:' || target when starts_with(target, '/') then 'x://' || host || target
 else 'x://' || host || regexp_extract(path, '^(.*/)?', 0) || target end as target from t where target <> ''),
 v as (select x, {_AFTER.format("target")} as rest from u), w as (select x, {_HOST.format("rest")} as host, {_PATH.format("rest")} as path from v),
 e as (select distinct x, {_NODE} as y from w),
 f as (select x, y from e where x is not null and y is not null union select y, x from e where x is not null and y is not null),
 reach(p, q) as (select node, node from c where node is not null union select p, y from reach join f on x = q),
 g as (select p as node, max(case when action = 'allow' then 1 else 0 end) as al, max(case when action = 'block' then 1 else 0 end) as bl from reach join c on c.node = q group by 1)
 select page_id, host, path, rule, coalesce(action, case when al = 1 then 'allow' when bl = 1 then 'block' else 'allow' end) as verdict from c left join g using (node)""",
    "op11_source_divergence": divergence.ORACLE,
    "op12_topk_search": topk.ORACLE,
    "op13_hard_negatives": negatives.ORACLE,
}
