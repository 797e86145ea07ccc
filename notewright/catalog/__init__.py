"""The registered queries, the SQL they are checked with, and the inputs both share."""
