"""Tables that results are kept in: partitioned by cohort, appended, cached, exported."""
