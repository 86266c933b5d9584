"""vaani: Spark-native preparation and evaluation of speech-transcript data.

Every operator takes and returns DataFrames or Columns; nothing is collected
to the driver except bounded summaries.  See README.md for the module map.
"""

__all__ = ["session"]
