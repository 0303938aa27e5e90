"""End-to-end jobs: collect, train, score; and the query catalogue."""
