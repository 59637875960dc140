"""loopweaver: single-cell contact-map analytics as lazy Spark DataFrame plans."""
