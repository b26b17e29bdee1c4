"""Report tables: one function of the workspace per published table."""
