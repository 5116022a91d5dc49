"""tessera — a Spark-native raw → Data Vault → star-schema warehouse.

Layers:

* ``sources``   — raw source scans with explicit schemas, the driver-table
                  adapter and the layered table store.
* ``functions`` — Column builders (hash keys, hashdiffs, date keys, tiers).
* ``operators`` — DataFrame operators: bronze extract, hub/link/satellite
                  loaders, SCD2 versioning, calendar, star joins, checks.
* ``plans``     — model specs and the pipeline that wires operators into the
                  bronze/silver/gold build, plus the data-test catalogue.
* ``streaming`` — Structured Streaming front end feeding landed extracts
                  into the same incremental silver load.

``python -m tessera`` runs the layers from the command line.
"""

from tessera.session import configure_session, scratch_root

__all__ = ["configure_session", "scratch_root"]
