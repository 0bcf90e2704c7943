"""Race timing and telemetry analytics as plain PySpark DataFrame functions.

Every function takes DataFrames and returns a DataFrame. ``plans`` holds the
whole reports and conversions, ``operators`` the steps they are made of,
``functions`` the column expressions and ``sources`` the readers and cleaners.
"""
