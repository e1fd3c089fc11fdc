"""Customer-data and kiosk analytics as Spark DataFrame operators.

Every public function takes and returns lazy DataFrames (or Columns); nothing
here collects data to the driver except the small model summaries named so in
their docstrings.
"""
