"""Parameters of the catalog queries (shared by the Spark side and the SQL oracle)."""

PARAMS = {
    # target page flow of the conversion report (reference config: targetPageFlow)
    "flow": (1, 2, 3, 4, 5, 6, 7),
    # inclusive date bounds (reference config: startDate / endDate)
    "date_range": ("2024-01-05", "2024-01-07"),
    "flow_date_range": ("2024-01-05", "2024-01-20"),
    # Blacklist threshold for the catalog run. The library default is the
    # reference's 100; the test tables never give one (date, ad, user) more than
    # 4-6 clicks, so the catalog uses 3 to get a non-empty list.
    "threshold": 3,
    # page_flow_conversion_split: split every (session, hour) with more than this
    # many actions (1 = all of them), to check the exact split on whole tables
    "split_hot_rows": 1,
    # staged stream input: one file per 6 days of event time
    "stream_file_ms": 6 * 86400 * 1000,
    # stream_trend_arrival: seconds between the arrivals of two staged batches
    "arrival_step_s": 25,
}
