"""Session switches. A table's or server's own option is AND-ed with them."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass
class Settings:
    enable_join_pushdown: bool = True
    enable_aggregate_pushdown: bool = True
    enable_order_by_pushdown: bool = False
    enable_limit_pushdown: bool = True
