"""tillhouse: retail point-of-sale ELT and analytics on Spark DataFrames.

Layers (each a set of DataFrame -> DataFrame functions, no actions inside
except in ``sources.landing`` and ``plans.jobs``):

* ``sources``   - driver-table adapter, JDBC reads, landing, watermark state
* ``functions`` - Column helpers (cleaning, surrogate keys, calendar parts)
* ``operators`` - reusable relational operators (dedup, spine, top-k, reshape,
                  exact quantiles, data-quality checks)
* ``plans``     - staging models, marts, analytical questions, jobs
* ``streaming`` - file-arrival incremental landing (Structured Streaming)
"""

from tillhouse.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
