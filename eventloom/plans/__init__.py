"""Query plans over the driver tables: feeds (topics derived from tables),
the registered queries and their SQL oracles, and the view catalog."""
