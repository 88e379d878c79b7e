"""Column functions: everything here stays on the JVM except the XML helpers in ``xmltext``."""
