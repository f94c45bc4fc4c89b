"""Rule sets as data: patterns in Java and RE2 syntax alike, in the order in which they are tried."""
