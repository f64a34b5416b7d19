"""Column functions: nothing here touches a DataFrame or causes a shuffle."""
