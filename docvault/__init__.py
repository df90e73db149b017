"""docvault: backup, restore and migration of a multi-tenant JSON document store, as Spark jobs.

The store is a table ``(client, tenant, type, id, doc)``; a backup is a directory of per-type
dumps plus a manifest; a restore upserts those dumps into a target store snapshot.
"""

__all__ = ["session", "model"]
