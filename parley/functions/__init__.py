"""Column functions. All of them stay in the JVM except the two model hooks in ``models``."""
