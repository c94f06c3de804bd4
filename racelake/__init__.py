"""Medallion-style analytics for race-weekend results, written as DataFrame functions.

Every function takes DataFrames or Columns and returns DataFrames or Columns; nothing here
starts a session, runs an action on the data path or collects rows (the table helpers in
``sources.tables`` that write, of course, do write).
"""
