"""Writers: keyed replacement, partition replacement, retained history, reports and messages."""
