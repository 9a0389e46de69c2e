"""The driver's tables as a raw sales feed, the registered queries and their oracles."""
