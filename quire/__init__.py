"""quire: document-structure analytics as DataFrame-to-DataFrame operators on Spark."""
