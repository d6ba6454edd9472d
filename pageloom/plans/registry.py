"""All queries of the library's own operators and their SQL."""

from pageloom.plans import align, files, layout, logs, pixels, text

QUERIES = {**text.QUERIES, **align.QUERIES, **layout.QUERIES, **pixels.QUERIES, **logs.QUERIES, **files.QUERIES}
SQL = {**text.SQL, **align.SQL, **layout.SQL, **pixels.SQL, **logs.SQL, **files.SQL}
