"""Writers: partitions, keyed snapshots, documents, expiring keys, split exports."""
