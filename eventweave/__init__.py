"""eventweave: execution-event lineage and dataset cataloguing as Spark jobs.

Workflow-engine execution events go in (as a table or a stream); lineage comes
out as DataFrames: completed runs, their task chains, the datasets every task
read and wrote, dataset profiles, catalog field types, metadata change events,
lineage edges and catalog tables. Every step is a DataFrame transformation over
all runs at once.
"""

from eventweave.options import LineageOptions

__all__ = ["LineageOptions"]
__version__ = "0.1.0"
