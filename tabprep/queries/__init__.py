"""Registered queries, grouped by SURVEY section (each module registers into
``tabprep.registry``)."""
