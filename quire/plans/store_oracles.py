"""DuckDB SQL of ``store_queries``. Where a stored table must hold what a plain
update gives, the SQL is that update's."""

from __future__ import annotations

import datetime as dt


def store_oracles(plain: dict[str, str]) -> dict[str, str]:
    from quire.functions.search import resolve_date
    from quire.plans.oracles import CONFIG_PHRASES, NEWEST_PHRASES, keyword_sql, sql_str, with_papers
    from quire.plans.queries import AS_OF, SEARCH_CONFIG

    o = {"merged_replace": plain["upsert_replace"], "merged_insert": plain["insert_if_absent"],
         "merged_update": plain["partial_update"], "merged_summary": plain["upsert_summary"],
         "merged_selected": plain["set_selected"], "sections_replayed": plain["sections_current"],
         "search_indexed": plain["search_boolean"], "answers_kept": plain["generated_texts"],
         "parsed_files": plain["read_converted"], "packed_files": plain["read_converted"]}
    # a file holds a line and the text, those with doc_id % 8 = 5 what can't be converted
    body = "case when doc_id % 8 <> 5 then 'text' || chr(10) || coalesce(text, '') else 'bad' end"
    o["binary_files"] = with_papers(f"""
select paper_id as id, strlen({body}) as length, sha256({body}) as sha256 from papers join documents using (doc_id)""")
    o["conversion_observed"] = f"""
select count(*) as total, count(*) filter (where doc_id % 4 <> 0 and {body} <> 'bad') as ok,
       count(*) filter (where doc_id % 4 <> 0 and {body} = 'bad') as failed, count(*) filter (where doc_id % 4 = 0) as skipped
from documents"""
    o["table_versions"] = with_papers("""
, kept as (select p.doc_id, s.abstract from papers p join sections s on p.doc_id = s.doc_id
           where p.doc_id % 2 = 0 or p.doc_id % 3 = 0)
select 0 as version, 0 as n, 0 as n_filled
union all select 1, count(*), 0 from kept
union all select 2, count(*), count(*) filter (where doc_id % 3 = 0 and abstract is not null) from kept
union all select 3, 0, 0""", sections=True)
    as_of, span = dt.date.fromisoformat(AS_OF), SEARCH_CONFIG["date_range"]
    lo, hi = resolve_date(span["from"], as_of), resolve_date(span["to"], as_of) + dt.timedelta(days=1)
    authors = ", ".join(sql_str(a) for a in SEARCH_CONFIG["authors"])
    both = plain["search_boolean"][plain["search_boolean"].rindex("select paper_id from papers"):].partition("where ")[2]
    tests = {
        "worlds": (keyword_sql(["title", "content"], NEWEST_PHRASES), 25),
        "recent": (f"""{keyword_sql(['title', 'content'], CONFIG_PHRASES)} and list_has_any(author_names, [{authors}])
  and submitted_at >= timestamp '{lo} 00:00:00' and submitted_at < timestamp '{hi} 00:00:00'""", SEARCH_CONFIG["max_results"]),
        "both": (both, 10),
        "authors": (f"""({keyword_sql(['title', 'content'], ['que'])} and {keyword_sql(['title', 'content'], ['tion'])}
  or contains(lower(title), 'die')) and list_contains(author_names, 'Author 2')""", None),
    }
    o["searches_all"] = with_papers("\nunion all\n".join(
        f"(select '{name}' as search, {'row_number() over (order by submitted_at desc, paper_id)' if n else 'null'}::int as rank, "
        f"paper_id from papers where {test}{f' qualify rank <= {n}' if n else ''})" for name, (test, n) in tests.items()))
    o["extraction_observed"] = with_papers("""
, d as (select doc_id, abstract is not null or conclusion is not null as found,
               doc_id % 3 = 0 and (abstract is not null or conclusion is not null) as done, doc_id % 5 <> 0 as has_file
        from sections)
select count(*) as total_documents, count(*) filter (where has_file) as json_files,
       count(*) filter (where done) as previously_processed,
       count(*) filter (where has_file and not done and found) as ok,
       count(*) filter (where has_file and done) as skipped,
       count(*) filter (where not has_file or not done and not found) as failed
from d""", sections=True)
    o["labels_enforced"] = """
with l as (select case when doc_id % 11 <> 0 then doc_id end as doc_id, quality from labels)
select doc_id, quality, case when doc_id is null then 'no key'
  when doc_id not in (select doc_id from documents where doc_id % 7 <> 0) then 'no parent' end as reason
from l"""
    return o
