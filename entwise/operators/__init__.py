"""DataFrame -> DataFrame operators: incremental loads, change log, supplements,
cleaning, address classification, quality counts, dashboard metrics and views,
survey validation, and the hot-key-salted joins they share (``skew``)."""
