"""recordlink: record linkage and caption/text preparation as PySpark DataFrame operators."""
