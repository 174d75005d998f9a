"""Order-line ELT engine on Spark: ingest, quarantine, state, star-schema
marts, data tests and reports.

Entry points:
    tillflow.session.get_session             session with the engine settings
    tillflow.plans.pipeline.run_pipeline     one incremental batch (CSV, Parquet or DataFrame)
    tillflow.plans.pipeline.build_marts      staging views and mart tables
    tillflow.plans.pipeline.run_tests        the declared data tests
    tillflow.plans.pipeline.dashboard        the dashboard queries
    tillflow.streaming.file_ingest           Structured Streaming ingest of a landing folder
    python -m tillflow ...                   the same from the shell
"""
