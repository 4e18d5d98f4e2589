"""Job options (plain parameters instead of a config framework)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LineageOptions:
    # Fixed values that must equal the reference's defaults.
    # platform name, environment, succeeded phase codes, length gate
    platform: str = "flyte"
    env: str = "DEV"
    task_node_succeeded: int = 3          # kind in (task, node)
    workflow_succeeding: int = 3          # kind = workflow
    workflow_succeeded: int = 4           # kind = workflow
    end_node_marker: str = "end-node"
    node_suffix_excluded: str = "-node"
    min_events_exclusive: int = 7         # a run needs more than 7 events
    part_file: str = "/00000"             # the one part file the reference reads

    # Our own switches.
    min_tasks: int = 0                    # 0 = parity (runs with no task are rejected later)
    strict_nodes: bool = True             # task i must pair with node n{i}
    strict_types: bool = True             # converter accept set
    first_part_only: bool = False         # parity with the one-part-file scan
    emit: bool = True
    datasets_only: bool = False
    just_testing: bool = False
    db_name: str | None = None
    # Skew handling: a run with more rows than this is split into ordered
    # sub-ranges before any per-run window runs.
    hot_group_rows: int = 2_000_000


DEFAULT = LineageOptions()
