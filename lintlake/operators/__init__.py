"""Operators, grouped as in the survey: paths, catalog, planning, analysers, merge, gate, report, export."""
