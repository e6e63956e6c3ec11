"""Registered queries: every operator and job run on the driver's tables, with oracle SQL.

`standin` maps the driver's tables to the planning domain in Spark and
`standin_sql` does the same, independently, in SQL.
"""
