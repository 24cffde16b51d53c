"""The checked queries: name, Spark job and, where there is one, the SQL oracle."""

from rotativa.queries import learning, pages, partitions, quality, rows, streams, text  # noqa: F401
from rotativa.queries.base import ORACLES, QUERIES  # noqa: F401
