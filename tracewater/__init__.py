"""Regional substance screening as Spark DataFrame operators.

Every function takes and returns DataFrames or Columns; nothing here
collects data to the driver except one-row metadata answers (the newest
export's folder, the list of pivot columns), each with a stated bound.
"""
