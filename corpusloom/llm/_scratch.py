"""Intermediate tables in the folder that the cluster shares (see corpusloom.scratch)."""

from ..scratch import materialize, release, shared_dir

__all__ = ["materialize", "release", "shared_dir"]
