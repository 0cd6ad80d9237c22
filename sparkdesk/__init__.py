"""sparkdesk: ready-made Spark jobs for layered tables, panels, scoring, text corpora and retrieval.

Every public function takes DataFrames (or Columns) and returns DataFrames (or Columns).
"""
