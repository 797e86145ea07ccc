"""notewright: turn a corpus of free-text notes into structured records with Spark."""
