"""Independent SQL for every registered query, run by DuckDB on the same tables."""

BASE = """
WITH lines AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
           l_suppkey, l_shipdate, l_extendedprice) - 1 AS pos
  FROM lineitem
), t AS (
  SELECT l_orderkey AS k, 'W' || l_orderkey AS work_id, pos::BIGINT AS pos,
    CASE WHEN l_partkey % 97 = 0 THEN ' ' ELSE 'T' || l_partkey END AS id,
    p_name AS display_name, l_discount AS score, p_brand AS subfield_id, p_type AS field_id
  FROM lines JOIN part ON p_partkey = l_partkey
), a AS (
  SELECT l_orderkey AS k, 'W' || l_orderkey AS work_id, pos::BIGINT AS pos,
    CASE WHEN l_suppkey % 13 <> 0 THEN 'A' || l_suppkey END AS author_id,
    s_name AS author_name, CASE WHEN pos = 0 THEN 'first' ELSE 'middle' END AS author_position,
    l_returnflag = 'R' AS is_corresponding
  FROM lines JOIN supplier ON s_suppkey = l_suppkey
), i AS (
  SELECT l_orderkey AS k, 'W' || l_orderkey AS work_id, pos::BIGINT AS authorship_pos,
    'I' || s_nationkey AS id, n_name AS display_name, n_name AS country_code, r_name AS type
  FROM lines JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
), papers AS (
  SELECT o_orderkey AS k, 'W' || o_orderkey AS paper_id,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN ''
         WHEN o_orderkey % 13 = 0 THEN 'doi:' || o_orderkey
         ELSE 'https://doi.org/10.1/' || o_orderkey END AS doi,
    CASE WHEN o_orderkey % 19 <> 0 THEN 'Order ' || o_orderkey END AS title,
    CASE WHEN o_orderkey % 101 <> 0 THEN year(o_orderdate)::BIGINT END AS publication_year,
    o_orderdate::DATE AS publication_date, o_orderstatus AS work_type,
    CASE WHEN o_orderkey % 17 <> 0 THEN floor(o_totalprice / 1000)::BIGINT END AS cited_by_count,
    CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS is_open_access,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN lower(substr(o_orderpriority, 3))
         WHEN o_orderkey % 2 = 0 THEN ' ' END AS oa_status,
    first_topic.id AS primary_topic_id, first_topic.display_name AS primary_topic_name
  FROM orders LEFT JOIN (SELECT * FROM t WHERE pos = 0) first_topic ON first_topic.k = o_orderkey
), topics AS (
  SELECT id AS topic_id, arg_min(display_name, (work_id, pos)) AS topic_name,
    arg_min(subfield_id, (work_id, pos)) AS subfield_id, arg_min(field_id, (work_id, pos)) AS field_id
  FROM t WHERE trim(id) <> '' GROUP BY id
), paper_topics AS (
  SELECT work_id AS paper_id, id AS topic_id, max(score) AS topic_score,
    bool_or(id = primary_topic_id) AS is_primary_topic
  FROM t JOIN papers ON papers.k = t.k WHERE trim(id) <> '' GROUP BY ALL
), authors AS (
  SELECT author_id, arg_min(author_name, (work_id, pos)) AS author_name
  FROM a WHERE author_id IS NOT NULL GROUP BY author_id
), paper_authors AS (
  SELECT work_id AS paper_id, author_id, arg_min(author_position, pos) AS author_position,
    arg_min(is_corresponding, pos) AS is_corresponding
  FROM a WHERE author_id IS NOT NULL GROUP BY ALL
), institutions AS (
  SELECT id AS institution_id, min(display_name) AS institution_name,
    min(country_code) AS country_code, min(type) AS institution_type
  FROM i GROUP BY id
), paper_institutions AS (
  SELECT DISTINCT work_id AS paper_id, id AS institution_id FROM i
), publication_trends AS (
  SELECT y.publication_year, y.paper_count, y.total_citations, y.average_citations,
    p.paper_count AS previous_year_paper_count,
    100.0 * (y.paper_count - p.paper_count) / p.paper_count AS year_over_year_growth_percentage
  FROM (SELECT publication_year, count(*) AS paper_count, sum(cited_by_count)::BIGINT AS total_citations,
          avg(cited_by_count) AS average_citations
        FROM papers WHERE publication_year IS NOT NULL GROUP BY 1) y
  LEFT JOIN (SELECT publication_year, count(*) AS paper_count FROM papers GROUP BY 1) p
    ON p.publication_year = y.publication_year - 1
), topic_summary AS (
  SELECT topic_id, any_value(topic_name) AS topic_name, count(*) AS paper_count,
    sum(cited_by_count)::BIGINT AS total_citations, avg(cited_by_count) AS average_citations,
    median(cited_by_count) AS median_citations,
    100.0 * count(*) FILTER (is_open_access) / count(*) AS open_access_percentage
  FROM paper_topics JOIN papers USING (paper_id) JOIN topics USING (topic_id) GROUP BY topic_id
), topic_years AS (
  SELECT topic_id, publication_year, any_value(topic_name) AS topic_name, count(*) AS paper_count,
    sum(cited_by_count)::BIGINT AS total_citations, avg(cited_by_count) AS average_citations
  FROM paper_topics JOIN papers USING (paper_id) JOIN topics USING (topic_id)
  WHERE publication_year IS NOT NULL GROUP BY topic_id, publication_year
), topic_yearly_trends AS (
  SELECT y.*, p.paper_count AS previous_year_paper_count,
    100.0 * (y.paper_count - p.paper_count) / p.paper_count AS year_over_year_growth_percentage
  FROM topic_years y LEFT JOIN topic_years p
    ON p.topic_id = y.topic_id AND p.publication_year = y.publication_year - 1
), author_summary AS (
  SELECT author_id, any_value(author_name) AS author_name, count(*) AS paper_count,
    sum(cited_by_count)::BIGINT AS total_citations_of_authored_papers,
    avg(cited_by_count) AS average_citations_per_paper,
    count(*) FILTER (is_open_access) AS open_access_papers,
    100.0 * count(*) FILTER (is_open_access) / count(*) AS open_access_percentage
  FROM paper_authors JOIN papers USING (paper_id) JOIN authors USING (author_id) GROUP BY author_id
), institution_summary AS (
  SELECT institution_id, count(*) AS paper_count, sum(cited_by_count)::BIGINT AS total_citations,
    avg(cited_by_count) AS average_citations, any_value(institution_name) AS institution_name,
    any_value(country_code) AS country_code, any_value(institution_type) AS institution_type
  FROM paper_institutions JOIN papers USING (paper_id) JOIN institutions USING (institution_id)
  GROUP BY institution_id
), status AS (
  SELECT CASE WHEN oa_status IS NULL OR trim(oa_status) = '' THEN 'unknown'
         ELSE trim(oa_status) END AS oa_status, count(*) AS paper_count
  FROM papers GROUP BY 1
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY cited_by_count DESC NULLS LAST, paper_id)::BIGINT AS citation_rank
  FROM papers
)
"""

_EXPLORE = (
    "paper_id, title, publication_year, cited_by_count, primary_topic_name, "
    "is_open_access, oa_status, doi"
)
_BY_CITATIONS = "ORDER BY cited_by_count DESC NULLS LAST, paper_id"
_UNKNOWN = "(oa_status IS NULL OR trim(oa_status) = '')"


def _member(topic):
    return f"paper_id IN (SELECT paper_id FROM paper_topics WHERE topic_id = '{topic}')"


def _sample(name, keys):
    text = " || '|' || ".join(keys)
    return (
        f"SELECT * FROM (SELECT '{name}' AS table_name, {text} AS sample_key, "
        f"(SELECT count(*) FROM {name}) AS row_count FROM {name} ORDER BY {', '.join(keys)} LIMIT 3)"
    )


_LINE = "'L' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || l_shipdate::DATE::VARCHAR"
_NESTED = f"""
        , nt AS (
          SELECT {_LINE} AS work_id, unnest([0, 1, 2])::BIGINT AS pos,
            unnest(['T' || l_partkey % 50, 'T' || l_suppkey % 50, 'T' || l_partkey % 50]) AS id,
            'n' || l_linenumber AS display_name, unnest([l_discount, l_tax, l_tax]) AS score,
            'T' || l_partkey % 50 AS primary_id
          FROM lineitem
        ), na AS (
          SELECT {_LINE} AS work_id, unnest([0, 1])::BIGINT AS pos,
            unnest(['A' || l_suppkey, 'A' || l_partkey % 10]) AS author_id,
            unnest(['first', 'last']) AS author_position, l_returnflag = 'R' AS is_corresponding
          FROM lineitem
        ), ni AS (
          SELECT {_LINE} AS work_id, unnest([0, 0, 1])::BIGINT AS authorship_pos, unnest([0, 1, 0])::BIGINT AS pos,
            unnest(['I' || l_suppkey % 25, 'I' || l_partkey % 25, 'I' || l_suppkey % 25]) AS id
          FROM lineitem
        )
        """


def _grain(bridge, key):
    return f"""
        SELECT {key}, whole.n AS expected, part.n AS actual
        FROM (SELECT {key}, count(*) AS n FROM {bridge} GROUP BY 1) whole
        LEFT JOIN (SELECT {key}, count(*) AS n FROM {bridge} JOIN papers USING (paper_id)
                   WHERE k % 30 <> 0 GROUP BY 1) part USING ({key})
        WHERE part.n IS DISTINCT FROM whole.n"""


SELECTS = {
    "normalized_topics": _NESTED + "SELECT work_id, pos, id, display_name, score FROM nt",
    "normalized_authorships": _NESTED + "SELECT * FROM na",
    "normalized_institutions": _NESTED + "SELECT * FROM ni",
    "nested_paper_topics": _NESTED + """
        SELECT work_id AS paper_id, id AS topic_id, max(score) AS topic_score,
          bool_or(id = primary_id) AS is_primary_topic FROM nt GROUP BY ALL""",
    "nested_paper_authors": _NESTED + """
        SELECT work_id AS paper_id, author_id, arg_min(author_position, pos) AS author_position,
          arg_min(is_corresponding, pos) AS is_corresponding FROM na GROUP BY ALL""",
    "nested_paper_institutions": _NESTED + "SELECT DISTINCT work_id AS paper_id, id AS institution_id FROM ni",
    "observed_paths": """
        SELECT 'works' AS relation, unnest(['id', 'primary_topic.id', 'topics.*', 'topics.*.id',
          'topics.*.display_name', 'topics.*.score', 'authorships.*', 'authorships.*.author.id',
          'authorships.*.author_position', 'authorships.*.is_corresponding', 'authorships.*.institutions.*',
          'authorships.*.institutions.*.id']) AS path""",
    "merged_works": """
        SELECT paper_id AS id, CASE WHEN k % 5 <> 0 THEN title END AS title,
          cited_by_count + CASE WHEN k % 5 = 0 THEN 1000 ELSE 0 END AS cited_by_count FROM papers""",
    "bucketed_merge": """
        SELECT paper_id AS id, CASE WHEN k % 997 <> 0 THEN title END AS title,
          cited_by_count + CASE WHEN k % 997 = 0 THEN 1000 ELSE 0 END AS cited_by_count FROM papers""",
    "topic_cells_delta": """
        , links AS (
          SELECT paper_id, topic_id FROM paper_topics JOIN papers USING (paper_id) WHERE k % 50 <> 0
          UNION ALL SELECT paper_id, 'T1' FROM papers WHERE k % 50 = 0
        )
        SELECT topic_id, publication_year, cited AS cited_by_count, count(*) AS n, count(*) FILTER (is_open_access) AS oa,
          count(cited) AS known, coalesce(sum(cited), 0)::BIGINT AS cites
        FROM (SELECT *, cited_by_count + CASE WHEN k % 50 = 0 THEN 1000 ELSE 0 END AS cited FROM papers)
        JOIN links USING (paper_id) GROUP BY ALL""",
    "author_cells_delta": """
        SELECT author_id, count(*) AS n, count(*) FILTER (is_open_access) AS oa,
          count(cited_by_count) AS known, coalesce(sum(cited_by_count), 0)::BIGINT AS cites
        FROM papers JOIN paper_authors USING (paper_id) WHERE k % 50 <> 0 GROUP BY ALL""",
    "line_digests": """
        , placed AS (
          SELECT 'f' || o_orderkey % 5 AS path, md5('{"id":"W' || o_orderkey || '"}') AS hash,
            row_number() OVER (PARTITION BY o_orderkey % 5 ORDER BY o_orderkey) AS place
          FROM orders
        ), hashed AS (
          SELECT path, place, unnest([0, 1, 2, 3]) AS h,
            unnest([('0x' || hash[1:8])::BIGINT, ('0x' || hash[9:16])::BIGINT, ('0x' || hash[17:24])::BIGINT,
              ('0x' || hash[25:32])::BIGINT]) % 2147483647 AS value
          FROM placed
        ), sums AS (
          SELECT path, h, count(*) AS lines, (sum(value) % 2147483647)::BIGINT AS a,
            (sum(place * value % 2147483647) % 2147483647)::BIGINT AS b
          FROM hashed GROUP BY ALL
        )
        SELECT path, max(lines) AS lines,
          sha256(max(lines) || '-' || string_agg(a, '-' ORDER BY h) || '-' || string_agg(b, '-' ORDER BY h)) AS digest
        FROM sums GROUP BY path""",
    "rank_faults": """
        , shifted AS (
          SELECT citation_rank + CASE WHEN k % 100 = 0 THEN 1 ELSE 0 END AS citation_rank, paper_id,
            coalesce(-cited_by_count, 9223372036854775807) AS place FROM ranked
          UNION ALL SELECT 0, '', -9223372036854775808
        ), paired AS (
          SELECT *, lead(citation_rank) OVER w AS next_rank, lead(place) OVER w AS next_place, lead(paper_id) OVER w AS next_id
          FROM shifted WINDOW w AS (ORDER BY citation_rank, place, paper_id)
        )
        SELECT citation_rank, next_rank, CASE WHEN next_rank = citation_rank THEN 'repeated'
          WHEN next_rank > citation_rank + 1 THEN 'gap' ELSE 'order' END AS fault
        FROM paired WHERE next_rank IS NOT NULL AND (next_rank <> citation_rank + 1
          OR (place, paper_id) >= (next_place, next_id))""",
    "mistyped_fields": """
        SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN 'cited_by_count' WHEN 1 THEN 'cited_by_count'
            WHEN 2 THEN 'publication_year' WHEN 3 THEN 'cited_by_count' WHEN 4 THEN 'topics' WHEN 5 THEN 'topics'
            WHEN 6 THEN 'open_access.is_oa' WHEN 7 THEN 'title' ELSE '' END AS mistyped,
          CASE WHEN o_orderkey % 9 = 8 THEN 'fine' END AS title,
          CASE WHEN o_orderkey % 9 = 8 THEN 7::BIGINT END AS cited_by_count,
          NULL::BIGINT AS publication_year, NULL::BOOLEAN AS is_oa
        FROM orders""",
    "raw_gate": """
        , f AS (SELECT o_orderkey % 6 AS p, count(*) AS n FROM orders GROUP BY 1)
        SELECT 'f' || p AS path, 'raw.identity_json' AS check_name,
          CASE WHEN p = 3 THEN 'FAIL' ELSE 'PASS' END AS status,
          CASE WHEN p = 3 THEN 'invalid' ELSE n::VARCHAR END AS observed_value FROM f
        UNION ALL SELECT 'f' || p, 'raw.nonempty', 'PASS', n::VARCHAR FROM f WHERE p <> 3
        UNION ALL SELECT 'f' || p, 'raw.metadata', 'FAIL', 'invalid' FROM f WHERE p = 2
        UNION ALL SELECT 'f' || p, 'raw.actual_record_count', CASE WHEN p = 1 THEN 'FAIL' ELSE 'PASS' END,
          (n + CASE WHEN p = 1 THEN 1 ELSE 0 END)::VARCHAR FROM f WHERE p NOT IN (2, 3)""",
    "raw_gate_fields": """
        , f AS (SELECT o_orderkey % 10 AS p, count(*) AS n FROM orders GROUP BY 1)
        SELECT 'f' || p AS path, 'raw.' || c AS check_name, s AS status, v AS observed_value FROM (
          SELECT p, 'identity_json' AS c, 'PASS' AS s, n::VARCHAR AS v FROM f
          UNION ALL SELECT p, 'nonempty', 'PASS', n::VARCHAR FROM f
          UNION ALL SELECT p, unnest(['actual_record_count', 'records_extracted', 'source_match_count',
            'requested_max_records', 'max_records_requested', 'completeness']), 'PASS',
            unnest([n::VARCHAR, n::VARCHAR, (n + 1)::VARCHAR, n::VARCHAR, (n + 1)::VARCHAR, 'False']) FROM f WHERE p = 0
          UNION ALL SELECT p, 'records_extracted', 'FAIL', (n + 1)::VARCHAR FROM f WHERE p = 1
          UNION ALL SELECT p, 'source_match_count', 'FAIL', (n - 1)::VARCHAR FROM f WHERE p = 2
          UNION ALL SELECT p, 'requested_max_records', 'FAIL', 'invalid type' FROM f WHERE p = 3
          UNION ALL SELECT p, 'max_records_requested', 'FAIL', 'invalid type' FROM f WHERE p = 4
          UNION ALL SELECT p, 'source_match_count', 'PASS', (n + p - 5)::VARCHAR FROM f WHERE p IN (5, 6)
          UNION ALL SELECT p, 'completeness', CASE p WHEN 5 THEN 'PASS' ELSE 'FAIL' END, 'True' FROM f WHERE p IN (5, 6)
          UNION ALL SELECT p, 'completeness', 'FAIL', 'invalid type' FROM f WHERE p = 7
          UNION ALL SELECT p, 'metadata', 'WARN', 'absent' FROM f WHERE p = 8
          UNION ALL SELECT p, 'actual_record_count', 'FAIL', 'invalid type' FROM f WHERE p = 9)""",
    "exported_sidecars": """
        , matches AS (SELECT count(*) AS n FROM papers WHERE trim(oa_status) = 'urgent' AND publication_year = 1997)
        SELECT least(n, 300) AS actual_record_count, n AS source_match_count, 300::BIGINT AS requested_max_records,
          n <= 300 AS is_complete_extraction FROM matches""",
    "loaded_papers": """
        SELECT paper_id, doi, title, publication_year, work_type, cited_by_count, is_open_access, oa_status
        FROM papers WHERE trim(oa_status) = 'urgent' AND publication_year = 1997 ORDER BY paper_id LIMIT 300""",
    "recent_runs": """
        SELECT 'r' || o_orderkey AS run_id, CASE WHEN o_orderkey % 9 = 0 THEN 'failed' ELSE 'success' END AS status,
          0.5::DOUBLE * o_custkey AS duration_seconds
        FROM orders ORDER BY o_orderdate DESC, run_id LIMIT 10""",
    "optional_metrics": "SELECT * EXCLUDE (open_access_percentage) FROM topic_summary",
    "views_without_years": """
        SELECT 'overview_kpis' AS view, 1::BIGINT AS n UNION ALL SELECT 'topic_summary', count(*) FROM topic_summary
        UNION ALL SELECT 'top_papers', count(*) FROM papers UNION ALL SELECT 'author_summary', count(*) FROM author_summary
        UNION ALL SELECT 'institution_summary', count(*) FROM institution_summary""",
    "chart_rows": """
        SELECT unnest(['publications_over_time', 'year_over_year_growth', 'topic_trends']) AS chart, false AS usable
        UNION ALL SELECT unnest(['top_topics', 'citation_distribution', 'top_cited_papers', 'open_access_distribution',
          'top_authors', 'top_institutions']), count(*) > 0 FROM papers""",
    "presence_checks": """
        SELECT unnest(['papers', 'topics', 'paper_topics', 'authors', 'paper_authors', 'institutions',
          'paper_institutions']) || '.schema' AS check_name, 'curated' AS layer, 'PASS' AS status, 'True' AS observed_value
        UNION ALL SELECT unnest(['overview_kpis', 'publication_trends', 'topic_summary', 'topic_yearly_trends', 'top_papers',
          'author_summary', 'institution_summary', 'open_access_summary']) || '.queryable', 'analytics', 'PASS', 'queryable'
        UNION ALL SELECT 'overview_kpis.single_row', 'analytics', CASE WHEN abs(n - 1) = 0 THEN 'PASS' ELSE 'FAIL' END,
          abs(n - 1)::VARCHAR FROM (SELECT count(*) AS n FROM (SELECT count(*) FROM papers))""",
    "moved_files": "SELECT 'f' || o_orderkey AS file_path FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 4 = 0",
    "changed_files": "SELECT 'f' || o_orderkey AS file_path FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 4 = 0",
    "latest_entries": """
        SELECT o_custkey AS run_id, arg_max(o_orderstatus, o_orderkey) AS status, max(o_orderkey) AS sequence
        FROM orders GROUP BY 1""",
    "view_publication_trends": "FROM publication_trends",
    "view_topics": "SELECT * FROM topic_summary ORDER BY paper_count DESC, topic_id LIMIT 500",
    "view_topic_years": "SELECT * FROM topic_yearly_trends ORDER BY publication_year, topic_id LIMIT 10000",
    "view_authors": "SELECT * FROM author_summary ORDER BY paper_count DESC, author_id LIMIT 500",
    "view_institutions": "FROM institution_summary",
    "view_open_access": """
        SELECT oa_status, paper_count,
          100.0 * paper_count / (SELECT count(*) FROM papers) AS percentage_of_papers FROM status""",
    "topic_detail_summary": "SELECT * FROM topic_summary WHERE topic_id = 'T11'",
    "topic_detail_history": "SELECT * FROM topic_yearly_trends WHERE topic_id = 'T11'",
    "redact_documents": r"""
        SELECT doc_id, sha256(regexp_replace(coalesce(text, '') || ' Access_Token=t' || doc_id || '&end',
          '((?:api_key|access_token|password)=)[^\s\x1C-\x1F&]+', '\1[REDACTED]', 'gi')) AS redacted
        FROM documents""",
    "chosen_topic_series": """
        SELECT publication_year, topic_id, topic_name, paper_count FROM topic_years
        WHERE topic_id IN ('T7', 'T11', 'T13') QUALIFY count(*) OVER (PARTITION BY topic_id) >= 2""",
    "reconcile_author_grain": _grain("paper_authors", "author_id"),
    "reconcile_institution_grain": _grain("paper_institutions", "institution_id"),
    "view_counters": """
        SELECT count(*) + count(*) FILTER (topic_id LIKE '%11') AS rows,
          count(*) FILTER (topic_id LIKE '%11') AS repeated,
          count(*) FILTER (topic_id LIKE '%7' AND total_citations > 0) AS negative,
          0::BIGINT AS out_of_range
        FROM topic_summary""",
    "roll_up_results": """
        SELECT o_orderpriority AS layer, count(*) FILTER (o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0) AS "PASS",
          count(*) FILTER (o_orderkey % 7 <> 0 AND o_orderkey % 5 = 0) AS "WARN",
          count(*) FILTER (o_orderkey % 7 = 0) AS "FAIL"
        FROM orders GROUP BY 1""",
    "normalize_topics": "SELECT work_id, pos, id, display_name, score, subfield_id, field_id FROM t",
    "normalize_authorships": (
        "SELECT work_id, pos, author_id, author_name, author_position, is_corresponding FROM a"
    ),
    "normalize_institutions": (
        "SELECT work_id, authorship_pos, id, display_name, country_code, type FROM i"
    ),
    "lineage_institutions": "FROM paper_institutions",
    "read_work_lines": """
        SELECT o_orderkey, CASE WHEN ok THEN 'W' || o_orderkey END AS id,
          CASE WHEN ok THEN 'Order ' || o_orderkey END AS title,
          CASE WHEN ok THEN floor(o_totalprice / 1000)::BIGINT END AS cited_by_count,
          CASE WHEN ok THEN 0.5::DOUBLE END AS first_score,
          CASE o_orderkey % 50 WHEN 0 THEN 'not one JSON value' WHEN 1 THEN 'not an object'
            WHEN 2 THEN 'id is no visible text' WHEN 3 THEN 'id is no visible text'
            WHEN 4 THEN 'not one JSON value' END AS problem
        FROM (SELECT *, o_orderkey % 50 > 4 AS ok FROM orders)""",
    "select_works": """
        SELECT paper_id AS id, publication_year, cited_by_count FROM papers
        WHERE trim(oa_status) = 'urgent' AND publication_year = 1997 ORDER BY paper_id LIMIT 300""",
    "merge_latest": """
        SELECT paper_id AS id, cited_by_count + CASE WHEN k % 5 = 0 THEN 1000 ELSE 0 END AS cited_by_count,
          CASE WHEN k % 5 = 0 THEN 2 ELSE 1 END::BIGINT AS load_seq,
          CASE WHEN k % 5 = 0 THEN 0 ELSE (SELECT count(*) FROM t WHERE t.k = papers.k) END AS topic_rows
        FROM papers""",
    "curated_papers": "SELECT * EXCLUDE (k) FROM papers",
    "curated_topics": "FROM topics",
    "curated_paper_topics": "FROM paper_topics",
    "curated_authors": "FROM authors",
    "curated_paper_authors": "FROM paper_authors",
    "curated_institutions": "FROM institutions",
    "curated_paper_institutions": "FROM paper_institutions",
    "overview_kpis": """
        SELECT count(*) AS total_papers, sum(cited_by_count)::BIGINT AS total_citations,
          avg(cited_by_count) AS average_citations_per_paper,
          median(cited_by_count) AS median_citations_per_paper,
          count(*) FILTER (is_open_access) AS open_access_papers,
          100.0 * count(*) FILTER (is_open_access) / count(*) AS open_access_percentage,
          (SELECT count(*) FROM authors) AS unique_authors,
          (SELECT count(*) FROM topics) AS unique_topics,
          (SELECT count(*) FROM institutions) AS unique_institutions,
          min(publication_year) AS earliest_publication_year,
          max(publication_year) AS latest_publication_year
        FROM papers""",
    "publication_trends": "FROM publication_trends",
    "topic_summary": "FROM topic_summary",
    "topic_yearly_trends": "FROM topic_yearly_trends",
    "top_papers": """
        SELECT paper_id, title, doi, publication_year, cited_by_count, citation_rank,
          primary_topic_name, is_open_access, oa_status, 2005::BIGINT AS citation_reference_year,
          CASE WHEN publication_year <= 2005 THEN cited_by_count::DOUBLE / (2006 - publication_year)
          END AS citations_per_year_since_publication
        FROM ranked""",
    "author_summary": "FROM author_summary",
    "institution_summary": "FROM institution_summary",
    "open_access_summary": """
        SELECT oa_status, paper_count,
          100.0 * paper_count / (SELECT count(*) FROM papers) AS percentage_of_papers FROM status""",
    "papers_by_year": f"SELECT {_EXPLORE} FROM papers WHERE publication_year = 1998 {_BY_CITATIONS} LIMIT 50",
    "papers_by_topic": f"SELECT {_EXPLORE} FROM papers WHERE {_member('T11')} {_BY_CITATIONS} LIMIT 50",
    "papers_min_citations": f"""
        SELECT {_EXPLORE} FROM papers WHERE cited_by_count >= 490
        ORDER BY publication_year DESC NULLS LAST, paper_id LIMIT 200""",
    "papers_unknown_oa": f"SELECT {_EXPLORE} FROM papers WHERE {_UNKNOWN} {_BY_CITATIONS} LIMIT 100",
    "papers_combined": f"""
        SELECT {_EXPLORE} FROM papers WHERE publication_year = 1999 AND {_member('T1139')}
          AND cited_by_count >= 200 AND trim(oa_status) = 'low' {_BY_CITATIONS} LIMIT 50""",
    "papers_sorted_by_title": f"""
        SELECT {_EXPLORE} FROM papers ORDER BY title ASC NULLS LAST, paper_id LIMIT 50""",
    "view_topic_history": """
        SELECT * FROM topic_yearly_trends WHERE topic_id = 'T7' ORDER BY publication_year LIMIT 500""",
    "topic_detail_papers": f"SELECT {_EXPLORE} FROM papers WHERE {_member('T11')} {_BY_CITATIONS} LIMIT 20",
    **{
        f"{prefix}_{plural}": f"SELECT {key}, paper_count FROM {view} ORDER BY paper_count DESC, {key} LIMIT {n}"
        for prefix, n in (("top", 20), ("bench", 10))
        for plural, view, key in (
            ("topics", "topic_summary", "topic_id"),
            ("authors", "author_summary", "author_id"),
            ("institutions", "institution_summary", "institution_id"),
        )
    },
    "bench_papers": f"SELECT paper_id, cited_by_count FROM papers {_BY_CITATIONS} LIMIT 50",
    "bench_filtered_papers": f"""
        SELECT paper_id, cited_by_count FROM papers
        WHERE publication_year = (SELECT max(publication_year) FROM papers) AND cited_by_count >= 0
          AND paper_id IN (SELECT paper_id FROM paper_topics
                           WHERE topic_id = (SELECT min(topic_id) FROM paper_topics))
        {_BY_CITATIONS} LIMIT 50""",
    "top_cited_papers": """
        SELECT paper_id, coalesce(title, paper_id) AS label, cited_by_count FROM papers
        WHERE cited_by_count IS NOT NULL ORDER BY cited_by_count DESC, paper_id LIMIT 30""",
    "doi_links": """
        SELECT paper_id, CASE WHEN doi LIKE 'https://doi.org/%' OR doi LIKE 'http://doi.org/%'
          THEN doi END AS doi_link FROM papers""",
    "inspect_samples": " UNION ALL ".join(
        _sample(name, keys)
        for name, keys in (
            ("papers", ["paper_id"]),
            ("topics", ["topic_id"]),
            ("paper_topics", ["paper_id", "topic_id"]),
            ("authors", ["author_id"]),
            ("paper_authors", ["paper_id", "author_id"]),
            ("institutions", ["institution_id"]),
            ("paper_institutions", ["paper_id", "institution_id"]),
        )
    ),
    "redact_log_lines": """
        SELECT doc_id, 'run=' || doc_id || ' api_key=[REDACTED]&x=1 PASSWORD=[REDACTED] end' AS line
        FROM documents""",
    "series_with_gaps": """
        SELECT y AS publication_year, n AS paper_count
        FROM (SELECT unnest(generate_series(min(publication_year), max(publication_year))) AS y FROM papers)
        LEFT JOIN (SELECT publication_year, count(*) AS n FROM papers WHERE publication_year <> 1997
                   GROUP BY 1) ON publication_year = y""",
    "growth_bars": """
        SELECT publication_year, year_over_year_growth_percentage FROM publication_trends
        WHERE year_over_year_growth_percentage IS NOT NULL""",
    "top_topic_series": """
        SELECT publication_year, topic_id, topic_name, paper_count FROM topic_years
        WHERE topic_id IN (SELECT topic_id FROM topic_years GROUP BY topic_id
                           ORDER BY sum(paper_count) DESC, topic_id LIMIT 5)
        QUALIFY count(*) OVER (PARTITION BY topic_id) >= 2""",
    "citation_histogram": """
        , v AS (SELECT ln(1.0 + cited_by_count) AS scaled FROM papers WHERE cited_by_count >= 0
        ), s AS (
          SELECT greatest(max(scaled), 1.0) AS top,
            least(35, greatest(5, floor(sqrt(count(*)))))::BIGINT AS bins FROM v
        ), edges AS (
          SELECT e.bin AS bin, top * e.bin / bins AS lower_edge, top * (e.bin + 1) / bins AS upper_edge,
            e.bin = bins - 1 AS is_last
          FROM s, (SELECT unnest(range(0, 35)) AS bin) e WHERE e.bin < bins
        )
        SELECT bin, round(lower_edge, 9) AS lower_edge, round(upper_edge, 9) AS upper_edge,
          count(*) AS paper_count
        FROM edges JOIN v ON scaled >= lower_edge AND (scaled < upper_edge OR is_last) GROUP BY ALL""",
    "citation_markers": "SELECT avg(cited_by_count) AS mean, median(cited_by_count) AS median FROM papers",
    "open_access_bars": "SELECT oa_status, paper_count FROM status ORDER BY paper_count DESC, oa_status LIMIT 30",
    "orphan_lineage": """
        SELECT work_id, count(*) AS orphan_rows FROM t
        WHERE k % 10 = 3 OR k NOT IN (SELECT k FROM papers) GROUP BY work_id""",
    "duplicate_grain": "SELECT paper_id, 2::BIGINT AS n FROM papers WHERE k % 50 = 0",
    "invalid_ranges": """
        SELECT count(*) FILTER (k % 40 = 0 AND cited_by_count > 0) AS cited_by_count,
          count(*) FILTER (k % 60 = 0) AS publication_year FROM papers""",
    "blank_keys": """
        SELECT (SELECT count(*) FROM t WHERE trim(id) = '') AS blank_topic_ids,
          (SELECT count(*) FROM a WHERE author_id IS NULL) AS blank_author_ids""",
    "broken_references": """
        SELECT (SELECT count(*) FROM paper_topics WHERE paper_id NOT IN
                 (SELECT paper_id FROM papers WHERE k % 30 <> 0)) AS missing_papers,
          (SELECT count(*) FROM paper_topics WHERE topic_id NOT IN
                 (SELECT topic_id FROM topics)) AS missing_topics""",
    "coverage": f"""
        SELECT round(100.0 * count(*) FILTER (doi <> '') / count(*), 2) AS doi,
          round(100.0 * count(*) FILTER (trim(primary_topic_id) <> '') / count(*), 2) AS primary_topic,
          round(100.0 * count(*) FILTER (title <> '') / count(*), 2) AS title,
          round(100.0 * count(*) FILTER (is_open_access IS NOT NULL OR NOT {_UNKNOWN}) / count(*), 2)
            AS oa_information,
          round(100.0 * count(*) FILTER (paper_id IN (SELECT paper_id FROM paper_authors)) / count(*), 2)
            AS authors,
          round(100.0 * count(*) FILTER (paper_id IN (SELECT paper_id FROM paper_institutions)) / count(*), 2)
            AS institutions,
          count(DISTINCT publication_year) AS publication_years
        FROM papers""",
    "reconcile_totals": """
        SELECT count(*) AS papers, count(publication_year) AS known_year_papers,
          count(*) AS overview_total, count(publication_year) AS yearly_total, count(*) AS status_total
        FROM papers""",
    "reconcile_topic_grain": """
        SELECT topic_id, whole.n AS expected, part.n AS actual
        FROM (SELECT topic_id, count(*) AS n FROM paper_topics GROUP BY 1) whole
        LEFT JOIN (SELECT topic_id, count(*) AS n FROM paper_topics JOIN papers USING (paper_id)
                   WHERE k % 30 <> 0 GROUP BY 1) part USING (topic_id)
        WHERE part.n IS DISTINCT FROM whole.n""",
    "rank_violations": """
        SELECT paper_id, citation_rank + 1 AS citation_rank, citation_rank AS expected_rank
        FROM ranked WHERE k % 100 = 0""",
}

# Queries that need none of the shared relations but scan much are still given them:
# DuckDB evaluates only the relations a statement refers to.
SELECTS["view_overview"] = SELECTS["overview_kpis"]
ORACLE = {name: BASE + select for name, select in SELECTS.items()}
