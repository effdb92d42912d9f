"""Column-level building blocks: violation predicates and JSON helpers
(``predicates``) and zone-independent time conversions (``time``)."""
