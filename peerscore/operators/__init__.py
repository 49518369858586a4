"""DataFrame -> DataFrame operators: projections, joins, ranks, scaling, reshaping, upserts, audits, extraction."""
