"""DataFrame operators on catalogs, manifests and trace records."""
