"""Indicator analytics as Spark DataFrame plans.

Submissions, framework sheets and official figures in; a table of indicators
(code, year, place, value) out, rolled up, completed, cumulated and compared
with targets.  Every operator takes and returns DataFrames; nothing in the
package runs Python code per row.
"""
