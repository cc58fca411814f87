"""riskloom: credit-risk analytics as Spark plans."""
