"""Seeds.

Fixed values: ``dim_indicator_taxonomy.csv`` is the modelled warehouse's
taxonomy seed (source system, indicator code, topic, polarity; 101 rows, two
polarities with trailing blanks, two blank tail lines), kept byte for byte so
topics and polarities match.  ``standin_taxonomy.csv`` maps the stand-in
indicators derived from the test tables.
"""
