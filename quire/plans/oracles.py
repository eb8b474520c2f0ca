"""DuckDB SQL oracles for the registered queries.

Each oracle is plain SQL over the driver's pre-registered views. Shared
pieces (the ``papers`` fixture, section extraction) are CTE texts built
here once and composed per query. Regex patterns come from the same fixed
lists as the Spark side, rewritten for RE2 by ``sections.to_re2``.
"""

from __future__ import annotations

from quire.functions.sections import (ABSTRACT_PATTERNS, CONCLUSION_PATTERNS, DISCUSSION_PATTERNS,
                                      MIN_SECTION_CHARS, to_re2)

#: The fixed lists as they stand, not the shorter ones that the operators search.
SECTION_PATTERNS = {"abstract": ABSTRACT_PATTERNS, "conclusion": CONCLUSION_PATTERNS,
                    "discussion": DISCUSSION_PATTERNS}

PAPERS_BASE = r"""
papers_d as (
  select doc_id, lang, source, string_split(text, chr(10)) ls,
         doc_id % 6 av, (doc_id // 6) % 6 cv
  from documents),
papers_b as (
  select *, list_concat(
    ['Paper ' || doc_id],
    case av when 0 then ['Abstract', ls[1]] when 1 then ['ABSTRACT', ls[1]]
            when 2 then ['Abstract — ' || ls[1]] when 3 then ['Abstract: ' || ls[1]]
            when 4 then [ls[1]] else ['Abstract', substr(ls[1], 1, 20)] end,
    ['1 Introduction'], ls,
    case cv when 0 then ['5. Conclusions', ls[-1]] when 1 then ['CONCLUSION', ls[-1]]
            when 2 then ['Conclusion and Limitations', ls[-1]] when 3 then ['6 Discussion', ls[-1]]
            when 4 then ['Concluding Remarks', ls[-1]] else []::varchar[] end,
    ['References', '[1] cited work']) blocks
  from papers_d),
papers as (
  select b.doc_id,
    '2401.' || lpad(b.doc_id::varchar, greatest(6, length(b.doc_id::varchar))::int, '0') || 'v' || (b.doc_id % 3 + 1) as paper_id,
    substr(ls[1], 1, 60) as title,
    ['Author ' || (b.doc_id % 7), 'Author ' || (b.doc_id % 11)] as author_names,
    case when b.doc_id % 10 <> 0 then 'https://example.org/pdf/' || b.doc_id end as pdf_url,
    case b.doc_id % 4 when 0 then null when 1 then '' else source end as affiliation,
    b.blocks,
    array_to_string(list_transform(blocks, lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), chr(10)||chr(10)) || chr(10)||chr(10) as content,
    case when b.doc_id % 5 = 0 then '<entry></entry>' else
      '<entry><author><arxiv:affiliation> ' || source || ' </arxiv:affiliation></author><author><affiliation>' || source || '</affiliation></author>' ||
      case b.doc_id % 3 when 0 then '<arxiv:comment>Lab of ' || lang || '</arxiv:comment>'
                        when 1 then '<arxiv:comment>12 pages</arxiv:comment>' else '' end || '</entry>' end as atom_xml,
    timestamp '2024-01-01 00:00:00' + to_hours(b.doc_id) as submitted_at
  from papers_b b)"""

PAPERS_LABELLED = PAPERS_BASE + r""",
lpapers as (
  select p.*,
    case l.quality when 1 then 'yes' when 0 then 'no' end as selected,
    case p.doc_id % 6
      when 0 then '{"is_prestigious": ' || case when l.quality = 1 then 'true' else 'false' end || ', "reason": "q"}'
      when 1 then '{"is_prestigious": "' || case when l.quality = 1 then 'yes' else 'no' end || '", "reason": "q"}'
      when 2 then '{"is_prestigious": true}'
      when 3 then 'I think so'
      when 4 then '{"is_prestigious": ' || case when l.quality = 1 then '1' else '0' end || ', "reason": ""}'
      else '{"is_prestigious": true, "reason": 5}' end as model_response
  from papers p left join labels l on p.doc_id = l.doc_id)"""


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def first_long_match_sql(content: str, patterns: list[str]) -> str:
    parts = []
    for p in patterns:
        span = clean_sql(f"regexp_extract({content}, {sql_str(to_re2(p))}, 1)")
        parts.append(f"case when length({span}) > {MIN_SECTION_CHARS} then {span} end")
    return "coalesce(" + ",\n    ".join(parts) + ")"


def blank_sql(x: str) -> str:
    return f"({x} is null or regexp_matches({x}, '^\\s*$'))"


ABSTRACT_SQL = first_long_match_sql("content", SECTION_PATTERNS["abstract"])
CONCLUSION_SQL = first_long_match_sql(
    "content", SECTION_PATTERNS["conclusion"] + SECTION_PATTERNS["discussion"])

# (doc_id, paper_id, abstract, conclusion, status) for every paper.
SECTIONS_CTE = rf""",
sections_raw as (
  select doc_id, paper_id, content,
    case when not {blank_sql('content')} then {ABSTRACT_SQL} end as abstract,
    case when not {blank_sql('content')} then {CONCLUSION_SQL} end as conclusion
  from papers),
sections as (
  select doc_id, paper_id, abstract, conclusion,
    case when {blank_sql('content')} then 'no content'
         when abstract is null and conclusion is null then 'none'
         when abstract is null then 'no abstract'
         when conclusion is null then 'no conclusion'
         else 'ok' end as status
  from sections_raw)"""


def with_papers(body: str, labelled: bool = False, sections: bool = False) -> str:
    ctes = PAPERS_LABELLED if labelled else PAPERS_BASE
    if sections:
        ctes += SECTIONS_CTE
    return f"with {ctes}\n{body}"


# ------------------------------------------------------------ shared pieces

def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def decode_sql(x: str) -> str:
    from quire.functions.text import XML_ENTITIES
    out = x
    for ent, ch in XML_ENTITIES:
        out = f"replace({out}, {sql_str(ent)}, {sql_str(ch)})"
    return out


def first_tag_sql(x: str, tag: str) -> str:
    raw = f"regexp_extract({x}, '<{tag}(?:\\s[^>]*)?>([^<]+)</', 1)"
    return f"(case when {raw} <> '' then {strip_sql(decode_sql(raw))} end)"


def prompt_sql(a: str = "abstract", c: str = "conclusion") -> str:
    from quire.functions import prompts as P
    ha, hc = f"(not {blank_sql(a)})", f"(not {blank_sql(c)})"
    L = lambda text: sql_str(text).replace("\n", "' || chr(10) || '")
    return f"""(case when {ha} or {hc} then
      {L(P.SUMMARY_HEAD)} || case when {ha} and {hc} then {L(P.SUMMARY_BOTH)}
                         when {ha} then {L(P.SUMMARY_ABSTRACT)} else {L(P.SUMMARY_CONCLUSION)} end
      || {L(P.SUMMARY_FROM)}
      || case when {ha} then {L(P.ABSTRACT_LABEL)} || {strip_sql(a)} || {L(P.SECTION_END)} else '' end
      || case when {hc} then {L(P.CONCLUSION_LABEL)} || {strip_sql(c)} || {L(P.SECTION_END)} else '' end
      || {L(P.SUMMARY_ASK)} end)"""


def flag_sql(s: str, a: str = "abstract", c: str = "conclusion") -> str:
    from quire.functions import prompts as P
    ba, bc = blank_sql(a), blank_sql(c)
    return f"""(case when {s} is null or ({ba} and {bc}) then null
      when {ba} then {sql_str(P.MISSING_ABSTRACT + ' ')} || {s}
      when {bc} then {sql_str(P.MISSING_CONCLUSION + ' ')} || {s}
      else {s} end)"""


def lead_sql(a: str = "abstract", c: str = "conclusion") -> str:
    """Own statement of the rule: one or two sentences of the abstract, else of
    the conclusion; the whole section where no sentence ends."""
    section = f"(case when not {blank_sql(a)} then {a} when not {blank_sql(c)} then {c} end)"
    lead = f"nullif(regexp_extract({section}, '(?s)^\\s*((?:.*?[.!?](?:\\s|\\z)){{1,2}})', 1), '')"
    return f"nullif(trim(regexp_replace(coalesce({lead}, {section}), '\\s+', ' ', 'g')), '')"


def verdict_sql(m: str = "model_response") -> str:
    from quire.functions.verdict import TRUE_STRINGS
    true_strings = ", ".join(sql_str(t) for t in TRUE_STRINGS)
    j = f"(case when json_valid({m}) then {m} end)"
    t = f"json_type({j}, '$.is_prestigious')"
    truthy = f"""(({t} = 'BOOLEAN' and json_extract({j}, '$.is_prestigious')::varchar = 'true')
      or ({t} = 'VARCHAR' and lower(json_extract_string({j}, '$.is_prestigious'))
                              in ({true_strings}))
      or ({t} in ('UBIGINT', 'BIGINT', 'DOUBLE') and try_cast(json_extract({j}, '$.is_prestigious') as double) = 1))"""
    valid = (f"(regexp_matches({m}, '(?s)^\\s*\\{{.*\\}}\\s*$') and json_type({j}) = 'OBJECT' "
             f"and json_type({j}, '$.reason') = 'VARCHAR')")
    return f"(case when coalesce({valid} and {truthy}, false) then 'yes' else 'no' end)"


def keyword_sql(cols: list[str], phrases: list[str]) -> str:
    hits = [f"coalesce(contains(lower({c}), {sql_str(p)}), false)" for c in cols for p in phrases]
    return "(" + " or ".join(hits) + ")"


#: The phrases of the queries' search expressions, written by hand.
NEWEST_PHRASES = ["world model", "world models", "ndre", "eauou"]
CONFIG_PHRASES = ["ndre", "eauou", "the of"]


GEN_CTE = f""",
gen as (
  select doc_id, paper_id as id, {flag_sql(lead_sql())} as summary
  from sections)"""

STORED_FILLED_CTE = """,
stored as (
  select p.paper_id as id, p.title, array_to_string(p.author_names, ', ') as authors, p.pdf_url,
         s.abstract, s.conclusion, p.doc_id
  from papers p join sections s on p.doc_id = s.doc_id
  where (p.doc_id % 2 = 0 or p.doc_id % 3 = 0))"""

OLD_SUMMARIES_CTE = """,
old_summaries as (
  select paper_id as id, 'Summary of ' || title as summary from papers where (doc_id % 2 = 0 or doc_id % 3 = 0))"""

AFFILIATION_SQL = r"""(case when len(aff) > 0 then array_to_string(aff, '; ') end)"""


def _affiliation_body() -> str:
    from quire.functions.search import AFFILIATION_KEYWORDS
    import re as _re
    kw = "|".join(_re.escape(k) for k in AFFILIATION_KEYWORDS)
    tag_re = "<(?:arxiv:affiliation|affiliation)(?:\\s[^>]*)?>([^<]+)</"
    tags = (f"list_transform(regexp_extract_all(atom_xml, {sql_str(tag_re)}, 1), "
            f"lambda t: {strip_sql(decode_sql('t'))})")
    comment = first_tag_sql("atom_xml", "arxiv:comment")
    return f"""select paper_id, {AFFILIATION_SQL} as affiliation from (
  select paper_id, list_sort(list_distinct(list_concat({tags},
      case when {comment} is not null and regexp_matches(lower({comment}), {sql_str(kw)})
           then [{comment}] else []::varchar[] end))) as aff
  from papers)"""


def oracles() -> dict[str, str]:
    from quire.plans.queries import (AS_OF, AUTHORS, DATE_RANGE, SEARCH_CONFIG, SEARCH_MAX_RESULTS,
                                     SKIPPED_PAGE_MOD)
    from quire.functions.search import resolve_date
    import datetime as dt
    as_of = dt.date.fromisoformat(AS_OF)
    lo = resolve_date(DATE_RANGE[0], as_of)
    hi = resolve_date(DATE_RANGE[1], as_of) + dt.timedelta(days=1)
    authors = ", ".join(sql_str(a) for a in AUTHORS)
    sec_cols = "select doc_id, paper_id, abstract, conclusion, status from sections"
    o = {}
    o["extract_sections"] = with_papers(sec_cols, sections=True)
    o["parsed_sections"] = with_papers(sec_cols, sections=True)
    o["search_newest"] = with_papers(f"""
select paper_id, title, array_to_string(author_names, ', ') as authors from papers
where {keyword_sql(['title', 'content'], NEWEST_PHRASES)}
order by submitted_at desc, paper_id limit {SEARCH_MAX_RESULTS}""")
    cfg = SEARCH_CONFIG
    clo = resolve_date(cfg["date_range"]["from"], as_of)
    chi = resolve_date(cfg["date_range"]["to"], as_of) + dt.timedelta(days=1)
    cauthors = ", ".join(sql_str(a) for a in cfg["authors"])
    o["config_search"] = with_papers(f"""
select paper_id, title, array_to_string(author_names, ', ') as authors from papers
where {keyword_sql(['title', 'content'], CONFIG_PHRASES)}
  and list_has_any(author_names, [{cauthors}])
  and submitted_at >= timestamp '{clo} 00:00:00' and submitted_at < timestamp '{chi} 00:00:00'
order by submitted_at desc, paper_id limit {cfg['max_results']}""")
    o["fetch_upsert"] = with_papers(STORED_FILLED_CTE + f""",
hits as (
  select paper_id as id, title, array_to_string(author_names, ', ') as authors, pdf_url
  from papers
  where {keyword_sql(['title', 'content'], CONFIG_PHRASES)}
    and list_has_any(author_names, [{cauthors}])
    and submitted_at >= timestamp '{clo} 00:00:00' and submitted_at < timestamp '{chi} 00:00:00'
  order by submitted_at desc, paper_id limit {cfg['max_results']})
select id, title, authors, pdf_url, abstract, conclusion from stored
where id not in (select id from hits)
union all
select id, title, authors, pdf_url, null, null from hits""", sections=True)
    o["stream_sections"] = with_papers("""
select paper_id as id, abstract, conclusion from sections
where abstract is not null or conclusion is not null""", sections=True)
    o["row_counts"] = with_papers("""
select 'full_documents' as "table", count(*) as n from documents
union all
select 'labels', count(*) from labels""")
    o["papers_with_url"] = with_papers(
        "select paper_id, pdf_url from papers where pdf_url is not null")
    o["pending_papers"] = with_papers("""
select regexp_replace(paper_id, 'v\\d+$', '') as id, title,
       array_to_string(author_names, ', ') as authors,
       coalesce(nullif(affiliation, ''), 'Not provided') as affiliation
from lpapers where selected is null""", labelled=True)
    o["by_authors"] = with_papers(f"""
select paper_id, array_to_string(author_names, ', ') as authors from papers
where list_has_any(author_names, [{authors}])""")
    o["recent_events"] = f"""
select event_id, user_id, event_type, value from events
where ts >= timestamp '{lo} 00:00:00' and ts < timestamp '{hi} 00:00:00'"""
    o["affiliations"] = with_papers(_affiliation_body())
    o["page_titles"] = f"select page_id, {first_tag_sql('html', 'title')} as title from pages"
    o["summaries_report"] = with_papers(GEN_CTE + """
select p.paper_id as id, p.title, g.summary
from papers p join gen g on p.paper_id = g.id
where g.summary is not null order by id""", sections=True)
    o["unprocessed"] = with_papers("""
select paper_id from papers
where paper_id not in (select paper_id from papers where doc_id % 3 = 0)""")
    o["missing_outputs"] = with_papers("""
select paper_id, pdf_url from papers
where pdf_url is not null
  and paper_id not in (select paper_id from papers where doc_id % 4 = 0)""")
    o["match_known"] = with_papers("""
select n.paper_id,
       exists(select 1 from papers t where (t.doc_id % 2 = 0 or t.doc_id % 3 = 0)
              and t.paper_id = n.paper_id) as known
from papers n where (n.doc_id % 2 = 1 or n.doc_id % 3 = 0)""")
    o["with_parsed_file"] = with_papers("""
select t.paper_id,
       exists(select 1 from papers f where f.doc_id % 5 <> 0 and f.paper_id = t.paper_id) as has_file
from papers t""")
    o["selection_stats"] = with_papers("""
select selected,
       case when selected = 'yes' then 'selected' when selected = 'no' then 'rejected'
            else 'pending' end as label,
       count(*) as n
from lpapers group by selected""", labelled=True)
    o["extraction_counters"] = with_papers("""
select count(*) as total_documents,
       (select count(*) from papers where doc_id % 5 <> 0) as json_files,
       (select count(*) from papers where doc_id % 3 = 0) as previously_processed,
       count(*) filter (where o = 'ok') as ok,
       count(*) filter (where o = 'skipped') as skipped,
       count(*) filter (where o = 'failed') as failed
from (select case when doc_id % 5 = 0 then 'failed'
                  when doc_id % 3 = 0 then 'skipped'
                  when abstract is not null or conclusion is not null then 'ok'
                  else 'failed' end as o
      from sections)""", sections=True)
    m = SKIPPED_PAGE_MOD
    o["conversion_counters"] = f"""
select count(*) as total,
       count(*) filter (where page_id % {m} <> 0 and html is not null) as ok,
       count(*) filter (where page_id % {m} <> 0 and html is null) as failed,
       count(*) filter (where page_id % {m} = 0) as skipped
from pages"""
    o["upsert_replace"] = with_papers(STORED_FILLED_CTE + """,
batch as (
  select paper_id as id, title, array_to_string(author_names, ', ') as authors, pdf_url, 1 as seq
  from papers where (doc_id % 2 = 1 or doc_id % 3 = 0)
  union all
  select paper_id, title || ' (revised)', array_to_string(author_names, ', '), pdf_url, 2
  from papers where doc_id % 9 = 0),
latest as (
  select * from (select *, row_number() over (partition by id order by seq desc) as rn from batch)
  where rn = 1)
select id, title, authors, pdf_url, abstract, conclusion from stored
where id not in (select id from latest)
union all
select id, title, authors, pdf_url, null, null from latest""", sections=True)
    o["insert_if_absent"] = with_papers(OLD_SUMMARIES_CTE + """
select id, summary from old_summaries
union all
select paper_id, null from papers
where (doc_id % 2 = 1 or doc_id % 3 = 0) and paper_id not in (select id from old_summaries)""")
    o["partial_update"] = with_papers("""
select p.paper_id as id, p.title, array_to_string(p.author_names, ', ') as authors, p.pdf_url,
       case when p.doc_id % 3 = 0 then s.abstract end as abstract,
       case when p.doc_id % 3 = 0 then s.conclusion end as conclusion
from papers p join sections s on p.doc_id = s.doc_id
where (p.doc_id % 2 = 0 or p.doc_id % 3 = 0)""", sections=True)
    o["upsert_summary"] = with_papers(GEN_CTE + OLD_SUMMARIES_CTE + """,
new as (select id, summary from gen where (doc_id % 2 = 1 or doc_id % 3 = 0) and summary is not null)
select id, summary from old_summaries where id not in (select id from new)
union all
select id, summary from new""", sections=True)
    o["set_selected"] = with_papers(f"""
select paper_id as id, title, coalesce(selected, {verdict_sql()}) as selected
from lpapers""", labelled=True)
    o["verify_update"] = with_papers("""
, after as (
  select p.paper_id as id,
         case when p.doc_id % 3 = 0 then s.abstract end as abstract,
         case when p.doc_id % 3 = 0 then s.conclusion end as conclusion
  from papers p join sections s on p.doc_id = s.doc_id where (p.doc_id % 2 = 0 or p.doc_id % 3 = 0))
select n.paper_id as id,
       (n.abstract is null or n.abstract is not distinct from a.abstract)
       and (n.conclusion is null or n.conclusion is not distinct from a.conclusion) as verified
from sections n join after a on n.paper_id = a.id
where (n.doc_id % 2 = 1 or n.doc_id % 3 = 0) and (n.abstract is not null or n.conclusion is not null)""",
                                       sections=True)
    o["sections_appended"] = with_papers("""
, found as (select doc_id, paper_id as id, abstract, conclusion from sections
            where abstract is not null or conclusion is not null)
select id, abstract, conclusion from found where doc_id % 3 = 0
union all
select id, abstract, conclusion from found
where id not in (select id from found where doc_id % 3 = 0)""",
                                           sections=True)
    o["dump_rows"] = with_papers("""
select id, json_object(id, json_object('title', title, 'authors', authors, 'pdf_url', pdf_url,
                                       'abstract', abstract, 'conclusion', conclusion))::varchar as json
from (select p.paper_id as id, p.title, array_to_string(p.author_names, ', ') as authors, p.pdf_url,
             s.abstract, s.conclusion
      from papers p join sections s on p.doc_id = s.doc_id)""", sections=True)
    o["summary_prompt"] = with_papers(f"""
select paper_id, {prompt_sql()} as prompt from sections
where not {blank_sql('abstract')} or not {blank_sql('conclusion')}""", sections=True)
    o["flag_missing"] = with_papers(f"""
select s.paper_id, {flag_sql('p.title')} as summary
from sections s join papers p on s.doc_id = p.doc_id""", sections=True)
    o["lead_summary"] = with_papers(GEN_CTE + """
select id as paper_id, summary from gen""", sections=True)
    from quire.functions import prompts as P
    L = lambda text: sql_str(text).replace("\n", "' || chr(10) || '")
    o["relevance_prompt"] = with_papers(f"""
select p.paper_id as id,
  {L(P.RELEVANCE_HEAD)} || coalesce(p.title, {L(P.MISSING_VALUE)})
  || {L(P.RELEVANCE_AUTHORS)} || coalesce(array_to_string(p.author_names, ', '), {L(P.MISSING_VALUE)})
  || {L(P.RELEVANCE_AFFILIATION)} || coalesce(nullif(p.affiliation, ''), {L(P.NOT_PROVIDED)})
  || {L(P.RELEVANCE_ABSTRACT)} || coalesce(s.abstract, {L(P.MISSING_VALUE)})
  || {L(P.RELEVANCE_ASK)}
  as prompt
from lpapers p left join sections s on p.doc_id = s.doc_id
where p.selected is null""", labelled=True, sections=True)
    o["generated_texts"] = with_papers(f"""
select paper_id, nullif({strip_sql("right(" + prompt_sql() + ", 40)")}, '') as generated from sections""",
                                       sections=True)
    o["search_boolean"] = with_papers("""
select paper_id from papers
where (((contains(lower(title), 'ndre') or contains(lower(content), 'ndre'))
        and (contains(lower(title), 'the of') or contains(lower(content), 'the of')))
       and not (contains(lower(title), 'eauou') or contains(lower(content), 'eauou')))
   or (contains(lower(title), 'que') and (contains(lower(title), 'la') or contains(lower(content), 'la')))""")
    o["sections_current"] = with_papers("""
select paper_id as id, case when doc_id % 3 = 0 then abstract || ' (revised)' else abstract end as abstract,
       conclusion
from sections where abstract is not null or conclusion is not null""", sections=True)
    o["read_papers"] = with_papers("select paper_id as id, title, pdf_url from papers")
    o["read_converted"] = with_papers("select paper_id as id, content from papers")
    o["strict_ids"] = with_papers("""
select paper_id, string_split(paper_id, 'v')[1] as id, paper_id || '.tar' as stem from papers""")
    o["converted_lines"] = """
select doc_id, case when text is null then 'failed' else 'ok' end as status,
       case when text is null then -1 else len(string_split(text, chr(10))) end as n_blocks,
       string_split(text, chr(10))[1] as first_block
from documents"""
    o["orphan_labels"] = """
select doc_id, quality from labels
where doc_id not in (select doc_id from documents where doc_id % 7 <> 0)"""
    o["verdicts"] = with_papers(f"""
select paper_id, {verdict_sql()} as verdict from lpapers""", labelled=True)
    o["preview"] = with_papers("""
select s.paper_id,
  case when length(s.abstract) > 100 then substr(s.abstract, 1, 100) || '...' else s.abstract end
    as abstract_preview,
  array_to_string(string_split(p.content, chr(10))[1:5], chr(10)) as content_head
from sections s join papers p on s.doc_id = p.doc_id""", sections=True)
    from quire.plans.store_oracles import store_oracles
    return o | store_oracles(o)
