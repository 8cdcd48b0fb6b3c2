"""Source registry from a JSON document.

    {
      "smc": {"format": "jdbc",
              "options": {"url": "jdbc:mysql://host/smc", "user": "etl", "password": "${SMC_PASSWORD}",
                          "driver": "com.mysql.cj.jdbc.Driver"},
              "partitioning": {"ticket": {"column": "id", "num_partitions": 64, "balance": "quantiles"}},
              "default_partitioning": {"column": "id", "num_partitions": 16},
              "max_parallel_reads": 2},
      "warehouse": {"format": "jdbc", "quote": "",
                    "options": {"url": "${WAREHOUSE_JDBC_URL}", "user": "etl",
                                "password": "${WAREHOUSE_PASSWORD}"}},
      "crm": {"format": "records", "root": "s3a://landing/crm", "path_template": "{root}/{table}"}
    }

``max_parallel_reads`` caps the extracts reading a source at once (its
connections are at most that times ``num_partitions``).
``default_partitioning`` applies to every table without its own entry that
has the key column with an integral type; other tables are read whole.
``"quote": ""`` sends bare identifiers (``max(created_at) ... from ASSET``),
as a warehouse that folds unquoted names to upper case needs; the default
back-tick suits MySQL.  A warehouse may also be a catalog database
(``{"format": "table", "root": "smc"}``).

``${NAME}`` in an option value is replaced from the environment when the
file is loaded, so secrets stay out of the file and out of the code.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Mapping

from .jdbc import JdbcPartitioning
from .registry import SourceConfig, SourceRegistry

_VAR = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)\}")


def _expand(value: str) -> str:
    def sub(m: re.Match) -> str:
        name = m.group(1)
        if name not in os.environ:
            raise KeyError(f"environment variable {name} is not set")
        return os.environ[name]
    return _VAR.sub(sub, value)


def registry_from_dict(doc: Mapping[str, Mapping]) -> SourceRegistry:
    configs = []
    for name, body in doc.items():
        parts = {t: JdbcPartitioning(**p) for t, p in body.get("partitioning", {}).items()}
        default = body.get("default_partitioning")
        options = {k: _expand(str(v)) for k, v in body.get("options", {}).items()}
        kwargs = {k: body[k] for k in ("root", "path_template", "prefix", "quote", "max_parallel_reads", "auto_partitions")
                  if k in body}
        configs.append(SourceConfig(name=name, format=body["format"], options=options, partitioning=parts,
                                    default_partitioning=JdbcPartitioning(**default) if default else None, **kwargs))
    return SourceRegistry(configs)


def registry_from_json(path: str) -> SourceRegistry:
    with open(path) as f:
        return registry_from_dict(json.load(f))
