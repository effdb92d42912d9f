"""Operators over DataFrames: fused rule evaluation (``validate``), schema and
row-count checks (``schema``), the gate (``gate``), document and file checks
(``files``), row tags and samples (``tags``), reports (``report``) and
size-checked joins (``joins``)."""
