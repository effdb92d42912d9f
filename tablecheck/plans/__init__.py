"""Plans that combine operators: the registry (``registry``), gated suites over
many tables (``run``), whole-registry runs (``registry_run``), windowed
validation (``windows``), and the registered queries over the test tables with
their DuckDB oracles (``testdata_checks``, ``registered``, ``oracle_sql``)."""
