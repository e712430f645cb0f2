"""shelfwise: book-recommendation analytics as Spark DataFrame operators.

Every public operator takes DataFrames (plus plain parameters) and returns a
DataFrame; heavy work is expressed with the DataFrame/SQL API so Catalyst,
AQE and whole-stage codegen choose the physical plan.
"""

__all__ = ["session"]
