"""Column expressions and column-name helpers; nothing here touches rows outside the JVM."""
