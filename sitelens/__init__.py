"""sitelens: site-audit analytics over captured crawl data, built on Spark DataFrames.

Layout:
  functions/  Column -> Column expressions (URLs, HTML, status predicates)
  sources/    captures / sites readers, body cap, media routing, derived fixtures
  operators/  DataFrame -> DataFrame jobs (extraction, outcomes, graph, report, request audits)
  plans/      end-to-end audit composition and the query catalogue
  streaming/  Structured Streaming variants

SURVEY section 2 id -> entry point:
  S1 sources.captures.read_captures      S2 captures_from_pages     S3 site_config
  S4 operators.report.write_report       S5 sources.captures.cap_body   S6 route_by_media_type
  U0 functions.urls.canonicalize_urls    U1 normalize_url  U1q normalize_query  U1p escaped_path
  U2 normalize_or_keep  U3 with_default_scheme  U4 resolve_url  U5 same_domain  U6 is_special_url
  U7 operators.canonical.canonical_groups  U8 functions.urls.parse_error / url_error
  X0 operators.extract.extract_pages  X1 functions.html.extract_tags  X2 extract_links  X3 extract_assets
  X3a-e operators.extract.asset_refs  X4 functions.html.detect_asset_type  X5 extract_seo
  X6 operators.extract.extract_seo_xml  X7 functions.html.clean_text  X8 html_unescape
  F1 functions.status.is_retriable  F2 operators.outcomes.resolve_attempts  F3 backoff_plan
  F4 resolve_link_probe  F5/F6 resolve_asset_probe  F7 functions.status.status_label
  F8 operators.outcomes.page_rows  F9 apply_deadline
  F10 operators.requests.pacing_plan  F11 request_intervals  F12 request_counts  F13 user_agent_audit
  G1 operators.graph.classify_links  G2 crawl_depths  G3 operators.canonical.dedupe_first
  G4 operators.graph.link_worklist  G5 asset_worklist  G6 external_links  G7 unfetched_frontier
  R1 functions.status.is_broken  R2 operators.report.broken_links  R3 asset_inventory
  R4 operators.report.nest_pages  R5 ordered_pages  R6/R7 report_rows
  R8 generated_at parameter, date_trunc('second')  R9 plans.audit.audit
  T1 streaming.jobs.stream_claims  T2 stream_extract  T3 stream_broken_links  T4 frontier_rounds
"""
