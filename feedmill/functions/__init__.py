"""Column -> Column functions; every one but NFC stays in the JVM."""
