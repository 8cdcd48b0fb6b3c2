"""sparkload: manifest-driven table extracts and incremental loads on Spark.

Layers:

* ``functions``: time literals, window predicates, text clean-up;
* ``sources``: parquet / catalog-table / JDBC / landed-records readers,
  the catalog allow-list and warehouse marks;
* ``operators``: projection, distinct, delta, checked-broadcast cascade,
  row counting, lineage cuts;
* ``sinks``: CSV dialect and output path rules;
* ``plans``: the manifest, the load jobs, the report and plan checks;
"""

from .context import RunContext, apply_scale_conf, build_session, scratch_root

__version__ = "0.1.0"

__all__ = ["RunContext", "apply_scale_conf", "build_session", "scratch_root", "__version__"]
