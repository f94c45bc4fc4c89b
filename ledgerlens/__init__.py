"""ledgerlens: disclosure-text analytics expressed as PySpark DataFrame operators."""
