"""All queries of the library and the SQL of those that SQL can express."""

from __future__ import annotations

from . import features, files, maps, models, points

QUERIES = maps.Q | points.Q | features.Q | files.Q | models.Q
SQL = maps.SQL | points.SQL | features.SQL | files.SQL | models.SQL
