"""Query plans bound to the driver's tables (``catalogue``), their DuckDB
oracles (``oracle``) and the reference's jobs as parameterised functions
(``jobs``)."""
