"""Bike-share trip analytics expressed as PySpark DataFrame functions.

Every function takes DataFrames and returns a DataFrame; nothing is collected here.

* ``sources``   - readers and writers for trip files, stations, weather and file listings
* ``functions`` - column builders: calendar parts, labels, geometry, grid projection
* ``operators`` - the analytical questions
* ``plans``     - input tables derived from the test data, registered queries and their SQL
"""
