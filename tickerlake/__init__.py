"""tickerlake: set-based Spark jobs that keep equity-market tables clean and current.

Every job takes DataFrames and returns a DataFrame over all symbols at once.
Only built-in Spark expressions run per row; the one Arrow-batched helper is the
per-split line numbering used by the offset-CSV readers (see ``sources``).
"""

from tickerlake.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
__version__ = "0.1.0"
