"""Sources: manifests, catalog feeds, trace shards and corpus files."""
